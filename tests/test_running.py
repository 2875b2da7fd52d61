"""Running sums over range-partitioned pieces against a brute-force answer."""

import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyho.operators import replay, running, trailing


def _frame(spark, n=3000, seed=7, hot=0.34):
    rng = np.random.default_rng(seed)
    # one key holds about a third of the rows
    key = np.where(rng.random(n) < hot, "hot", rng.choice(["a", "b", "c", "d", "e"], n))
    pdf = pd.DataFrame(
        {"k": key, "t": rng.integers(0, 500, n), "id": np.arange(n), "v": rng.integers(-3, 4, n)}
    )
    return pdf, spark.createDataFrame(pdf)


def _brute(pdf):
    p = pdf.sort_values(["k", "t", "id"]).copy()
    p["want"] = p.groupby("k")["v"].cumsum()
    return dict(zip(p["id"], p["want"], strict=True))


@pytest.fixture()
def pieces(spark):
    """Keep small pieces apart, so that keys cross them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_key_crosses_pieces(spark, pieces):
    pdf, df = _frame(spark)
    cut = running.in_pieces(df, ["k"], ["t", "id"])
    assert cut.where("k = 'hot'").select("_piece").distinct().count() >= 3
    out = running.running_sum(df, ["k"], ["t", "id"], "v", "s")
    assert {r["id"]: r["s"] for r in out.collect()} == _brute(pdf)
    assert out.columns == ["k", "t", "id", "v", "s"]


def test_many_hot_keys_are_all_split(spark, pieces):
    """2,000 keys over more pieces than rows per key: each key's sum is right
    and no piece holds more than its share of rows."""
    n_keys, each = 2000, 12
    df = spark.range(n_keys * each).select((F.col("id") % n_keys).alias("k"), "id", F.lit(1).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        cut = running.in_pieces(df, ["k"], ["id"])
        rows = [r["count"] for r in cut.groupBy("_piece").count().collect()]
        assert len(rows) > 150 and max(rows) < 4 * n_keys * each / len(rows)
        out = running.row_index(df, ["k"], ["id"])
        bad = out.where(F.col("row_index") != F.expr(f"id div {n_keys}") + 1)
        assert bad.count() == 0 and out.count() == n_keys * each
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_null_keys_and_totals(spark, pieces):
    rows = [(None if i % 3 else "x", i, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, id long, v int")
    got = running.running_sum(df, ["k"], ["id"], "v", "s", totals={"n": F.count(F.lit(1)), "top": F.max("id")}).collect()
    assert len(got) == 200
    for r in got:
        same = [i for k, i, _ in rows if k == r["k"]]
        assert (r["s"], r["n"], r["top"]) == (same.index(r["id"]) + 1, len(same), max(same))


def test_one_plan_no_hint_no_collect(spark):
    """The plan doesn't depend on the data, and joins the offsets without a
    broadcast hint."""
    plans = []
    for n in (500, 3000):
        _, df = _frame(spark, n=n)
        out = running.running_sum(df, ["k"], ["t", "id"], "v", "s")
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    shape = [[line.strip(" :+-").split(" ")[0] for line in p.splitlines()] for p in plans]
    assert shape[0] == shape[1] and "strategy=broadcast" not in plans[0]


def test_many_partitions_cost_little(spark):
    """One key and 5,000 shuffle partitions: within 3 times of the plain
    window."""
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        df = spark.range(2_000_000).select(F.lit("hot").alias("k"), F.xxhash64("id").alias("t"), "id", F.lit(1).alias("v"))
        plain = df.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)))
        seconds = []
        for make in (lambda: plain, lambda: running.running_sum(df, ["k"], ["t", "id"], "v", "s")):
            best = 1e9
            for _ in range(2):
                start = time.time()
                make().write.format("noop").mode("overwrite").save()
                best = min(best, time.time() - start)
            seconds.append(best)
        assert seconds[1] < 3 * seconds[0] + 5, seconds  # 5 s for its extra jobs
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_spread_with_hot_file(spark, pieces):
    rows = [("big" if i % 3 else f"f{i % 5}", i, f"20150218101500-{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "file string, seq long, record_key string")
    got = {r["seq"]: (r["line_no"], r["lines"], r["event_ms"]) for r in replay.spread_event_times(df).collect()}
    files = {}
    for f, i, _ in rows:
        files.setdefault(f, []).append(i)
    base = 1424254500000
    for seqs in files.values():
        for no, i in enumerate(seqs, 1):
            assert got[i] == (no, len(seqs), base + (no - 1) * (900_000 // len(seqs)))


def test_equal_sequence_numbers_are_ordered_by_key(spark):
    df = spark.createDataFrame([("f", 0, k) for k in ("20150218101500-b", "20150218101500-a")], "file string, seq long, record_key string")
    got = {r["record_key"][-1]: r["line_no"] for r in replay.spread_event_times(df).collect()}
    assert got == {"a": 1, "b": 2}


def test_feed_lines_are_shuffled_once(spark, pieces, tmp_dir):
    """One segment over many pieces, lines with equal numbers and equal ids among them: every
    line has a time of its own in order, and after the pieces no line is shuffled again."""
    ids = [(i % 3 == 0, i // 2 if i < 600 else 7) for i in range(700)]
    lines = [f"20150218{'101500' if a else '103000'}-{n}\tline {i}" for i, (a, n) in enumerate(ids)]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    records = replay.feed_records(df, path=f"{tmp_dir}/pieces")
    assert spark.read.parquet(f"{tmp_dir}/pieces").select("_piece").distinct().count() > 3
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("BroadcastExchange")], plan  # the lines' side of the join
    got = records.orderBy("event_ms").collect()
    assert sorted(r["value"] for r in got) == sorted(lines)
    for stamp, base in (("20150218101500", 1424254500000), ("20150218103000", 1424255400000)):
        own = [r for r in got if r["key"].startswith(stamp)]
        assert [r["event_ms"] for r in own] == [base + i * (900_000 // len(own)) for i in range(len(own))]
        numbers = [(int(r["key"].split("-")[1]), r["key"]) for r in own]
        assert numbers == sorted(numbers)


def test_scratch_that_is_no_longer_read_goes(spark, tmp_dir):
    import os

    from tallyho.session import drop_scratch, scratch_path, shuffles_dropped

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        running.in_pieces(spark.range(9), ["id"], [], gone := scratch_path(spark, "gone"))
    assert spark.conf.get(key, None) == before
    spark.range(9).write.parquet(kept := scratch_path(spark, "kept"))
    drop_scratch(spark, gone)
    local = lambda p: p.removeprefix("file:")
    assert not os.path.exists(local(gone)) and os.path.exists(local(kept))
    for other in (tmp_dir, os.path.dirname(gone), os.path.dirname(gone) + "/"):
        with pytest.raises(ValueError):
            drop_scratch(spark, other)
    assert os.path.exists(local(kept))


def test_trailing_hot_name(spark, pieces):
    rng = np.random.default_rng(3)
    ts = pd.to_datetime("2015-02-18") + pd.to_timedelta(np.sort(rng.integers(0, 86400, 800)), unit="s")
    names = np.where(rng.random(800) < 0.5, "hot", rng.choice(["x", "y"], 800))
    pdf = pd.DataFrame({"event_id": np.arange(800), "name": names, "ts": ts})
    m = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp"))
    steps = trailing.steps(m).toPandas().sort_values(["name", "change_ts", "d", "event_id"])
    steps["n"] = steps.groupby("name")["d"].cumsum()
    want = {(r.event_id, r.kind): r.n for r in steps.itertuples()}
    got = {(r["event_id"], r["kind"]): r["n"] for r in trailing.trailing_changelog(m).collect()}
    assert got == want and min(got.values()) >= 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    n=st.integers(min_value=1, max_value=400),
    keys=st.integers(min_value=1, max_value=4),
    ties=st.integers(min_value=1, max_value=30),
    seed=st.integers(min_value=0, max_value=10_000),
)
def test_running_sum_property(spark, pieces, n, keys, ties, seed):
    """Any mix of keys and heavy ties in the first order column: equal to the
    brute-force cumulative sum."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "k": rng.choice([f"k{i}" for i in range(keys)], n),
            "t": rng.integers(0, ties, n),
            "id": rng.permutation(n),
            "v": rng.integers(-5, 6, n),
        }
    )
    out = running.running_sum(spark.createDataFrame(pdf), ["k"], ["t", "id"], "v", "s")
    got = {r["id"]: r["s"] for r in out.collect()}
    assert len(got) == n
    assert got == _brute(pdf)
