"""Tables kept by versions: daily counts that follow segments, upserts, packed files."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyho.operators import increments
from tallyho.sources import packing, upserts

DAY = dt.date(2015, 2, 18)


def days_after(k):
    return DAY + dt.timedelta(days=k)


def tops(counts, k):
    out = []
    for day in {d for d, _ in counts}:
        names = sorted(((-n, name) for (d, name), n in counts.items() if d == day and n))
        out += [(day, i, name, -n) for i, (n, name) in enumerate(names[:k], 1)]
    return sorted(out)


def offer(spark, counts, number, held):
    """Offer segments given as {segment: [(day, name)]}."""
    segments = spark.createDataFrame([(s,) for s in held] * 2, "segment string")
    rows = [(s, d, n) for s, own in held.items() for d, n in own]
    counts.offer(number, segments, spark.createDataFrame(rows, "segment string, day date, name string"))


def test_counts_follow_segments(spark, tmp_dir):
    r = random.Random(5)
    counts, have = increments.DailyCounts(spark, tmp_dir, k=3), {}
    for number in range(1, 5):
        # Segments of days 0 to 3; some again with other rows, one emptied.
        held = {
            f"s{k}": [(days_after(k % 4), f"n{r.randrange(6)}") for _ in range(r.randrange(30))]
            for k in r.sample(range(12), 5)
        }
        held["s1"] = [] if number == 3 else held.get("s1", [(days_after(1), "n1")])
        have.update(held)
        offer(spark, counts, number, held)
        want = tops(Counter(x for own in have.values() for x in own), 3)
        assert sorted(map(tuple, counts.top().collect())) == want
        # Repeated under its number, a run gives the same.
        offer(spark, counts, number, held)
        assert sorted(map(tuple, counts.top().collect())) == want


def test_only_touched_days_are_made_anew(spark, tmp_dir):
    counts = increments.DailyCounts(spark, tmp_dir)
    offer(spark, counts, 1, {f"s{k}": [(days_after(k), "a"), (days_after(k), "b")] for k in range(4)})
    offer(spark, counts, 2, {"s1": [(days_after(1), "b")], "s2": [(days_after(2), "b"), (days_after(2), "a")]})
    assert dict(map(tuple, counts.tops.live(2).collect())) == {days_after(k): 2 if k == 1 else 1 for k in range(4)}
    written = spark.read.parquet(f"{tmp_dir}/days/data/version=2")
    assert written.collect() == [(days_after(1), "b", 1)]
    offer(spark, counts, 3, {"s3": [], "s9": []})  # a day that loses all
    assert {r["day"] for r in counts.top().collect()} == {days_after(k) for k in range(3)}


def test_unlisted_versions_are_pruned(spark, tmp_dir):
    counts = increments.DailyCounts(spark, tmp_dir)
    for number in (1, 2):
        offer(spark, counts, number, {"s": [(DAY, "a")]})
    plan = counts.top()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_readers_of_an_earlier_run_and_runs_that_failed(spark, tmp_dir):
    counts = increments.DailyCounts(spark, tmp_dir)
    offer(spark, counts, 1, {"s": [(DAY, "a")]})
    before = counts.top()
    # A run that got as far as the rows of its days.
    spark.createDataFrame([(DAY, 1, "z", 9)], increments.TOPS).write.parquet(f"{tmp_dir}/tops/data/version=2")
    assert counts.top().collect() == [(DAY, 1, "a", 1)]
    offer(spark, counts, 2, {"s": [(DAY, "b")]})
    assert before.collect() == [(DAY, 1, "a", 1)] and counts.top().collect() == [(DAY, 1, "b", 1)]


def test_nothing_offered(spark, tmp_dir):
    counts = increments.DailyCounts(spark, tmp_dir)
    assert counts.top().collect() == []
    offer(spark, counts, 1, {})
    assert counts.top().collect() == []


def latest(table, version=None):
    return dict(map(tuple, table.read(version).collect()))


def test_upserts_and_compaction(spark, tmp_dir):
    table = upserts.LatestCounts(spark, tmp_dir)
    assert latest(table) == {}

    def put(version, **counts):
        table.upsert(version, spark.createDataFrame(list(counts.items()), "name string, n long"))

    put(1, a=1, b=2)
    put(2, a=5, c=1)
    put(3, b=0, d=4)
    open_reader = table.read()
    assert latest(table) == {"a": 5, "c": 1, "d": 4} and latest(table, 2) == {"a": 5, "b": 2, "c": 1}
    table.compact(4, upto=2)  # batch 3 landed meanwhile and stays above the base
    assert latest(table) == {"a": 5, "c": 1, "d": 4}
    assert table.table.live(4).count() == 2
    put(5, c=0, b=7)
    put(5, c=0, b=7)
    assert latest(table) == {"a": 5, "b": 7, "d": 4}
    assert dict(map(tuple, open_reader.collect())) == {"a": 5, "c": 1, "d": 4}
    table.compact(6, upto=5)
    assert table.table.live(6).count() == 1 and latest(table) == {"a": 5, "b": 7, "d": 4}


SCHEMA = "id long, value string"


def land(spark, folder, begin, end, files):
    rows = spark.range(begin, end).select("id", F.md5(F.col("id").cast("string")).alias("value"))
    rows.repartition(files).write.mode("append").parquet(folder)


def files(spark, folder):
    return {r["path"]: r["bytes"] for r in packing.live_files(spark, folder).collect()}


def test_packing_leaves_large_files_and_packed_folders(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert packing.pack(spark, tmp_dir + "/none", schema) == 0
    assert packing.read_packed(spark, tmp_dir + "/none", schema).collect() == []
    folder = os.path.join(tmp_dir, "feed")
    land(spark, folder, 0, 20_000, 1)
    (large,) = files(spark, folder)
    land(spark, folder, 20_000, 30_000, 40)
    target = files(spark, folder)[large]
    assert packing.pack(spark, folder, schema, target) == 40
    packed = files(spark, folder)
    assert large in packed and len(packed) < 5
    assert packing.pack(spark, folder, schema, target) <= 1 or max(packed.values()) < target / 2
    assert sorted(r["id"] for r in packing.read_packed(spark, folder, schema).collect()) == list(range(30_000))
    land(spark, folder, 30_000, 31_000, 8)
    before = packing.read_packed(spark, folder, schema)
    assert packing.pack(spark, folder, schema, target) >= 8
    now = files(spark, folder)
    assert large in now and now[large] == target
    assert packing.pack(spark, folder, schema, target) == 0 and files(spark, folder) == now
    for rows in (before, packing.read_packed(spark, folder, schema)):
        assert sorted(r["id"] for r in rows.collect()) == list(range(31_000))


@pytest.mark.parametrize("name", ["plain", "with space=x&%41"])
def test_a_run_that_failed_does_not_count(spark, tmp_dir, name):
    schema = spark.createDataFrame([], SCHEMA).schema
    folder = os.path.join(tmp_dir, name)
    land(spark, folder, 0, 100, 5)
    land(spark, f"{folder}/_packed/data/run=1/_bin=0", 0, 50, 1)  # its list was not written
    assert packing.read_packed(spark, folder, schema).count() == 100
    assert packing.pack(spark, folder, schema, 10**6) == 5
    assert sorted(r["id"] for r in packing.read_packed(spark, folder, schema).collect()) == list(range(100))
    assert len(files(spark, folder)) == 1
