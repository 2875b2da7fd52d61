"""Record keys, slots, segment names, event-time spread and pacing."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyho.functions import keys, times
from tallyho.operators import replay, segments


def test_record_key_parse(spark):
    df = spark.createDataFrame(
        [("20150218230000-7",), ("x-1",), ("1-2-3",), ("5-",), ("-5",), (None,), ("1-2-",), ("1-2--",), ("-",)], "k string"
    )
    got = [tuple(r) for r in df.select(keys.parse_record_key("k").alias("p")).select("p.*").collect()]
    assert got == [(20150218230000, 7), (0, 0), (0, 0), (0, 0), (0, 0), (0, 0), (1, 2), (1, 2), (0, 0)]


def test_last_record_key_default(spark):
    empty = spark.createDataFrame([], "record_key string")
    assert segments.last_record_key(empty).first()["last_key"] == "20150218230000-0"
    df = spark.createDataFrame([("20150218230000-7",), ("20150218230000-12",), ("20150218220000-99",)], "record_key string")
    assert segments.last_record_key(df).first()["last_key"] == "20150218230000-12"


def test_slot_end_and_names(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2015, 2, 18, 23, 59, 59),), (dt.datetime(2015, 2, 18, 10, 15, 0),)], "ts timestamp"
    )
    rows = df.select(
        times.slot_end("ts").alias("e"), times.segment_name(times.slot_start("ts")).alias("n")
    ).collect()
    assert rows[0]["e"] == dt.datetime(2015, 2, 19, 0, 0)
    assert rows[1]["e"] == dt.datetime(2015, 2, 18, 10, 30)
    assert rows[0]["n"] == "20150218234500.gkg.csv"
    assert rows[1]["n"] == "20150218101500.gkg.csv"


def test_poll_window(spark):
    df = spark.createDataFrame([(dt.datetime(2015, 2, 18, 10, 7, 30),)], "now timestamp")
    got = df.select(segments.poll_window("now", 60).alias("w")).first()["w"]
    assert got == [
        "20150218090000.gkg.csv",
        "20150218091500.gkg.csv",
        "20150218093000.gkg.csv",
        "20150218094500.gkg.csv",
    ]


def test_missing_and_new_segments(spark):
    landed = spark.createDataFrame(
        [("20150218230000.gkg.csv",), ("20150219000000.gkg.csv",), ("20150218224500.gkg.csv",)], "file_name string"
    )
    exp = segments.expected_segments(landed)
    assert exp.count() == 6
    miss = sorted(r[0] for r in segments.missing_segments(exp, landed).collect())
    assert miss == ["20150218231500.gkg.csv", "20150218233000.gkg.csv", "20150218234500.gkg.csv"]
    new = segments.new_segments(landed, "20150218224500.gkg.csv").collect()
    assert sorted(r["file_name"] for r in new) == ["20150218230000.gkg.csv", "20150219000000.gkg.csv"]
    assert {r["next_mark"] for r in new} == {"20150219000000.gkg.csv"}
    # the next poll goes on from there and offers each file once
    assert segments.new_segments(landed, new[0]["next_mark"]).collect() == []
    more = landed.union(spark.createDataFrame([("20150219001500.gkg.csv",)], "file_name string"))
    again = segments.new_segments(more, new[0]["next_mark"]).collect()
    assert [tuple(r) for r in again] == [("20150219001500.gkg.csv",) * 2]


def _records(spark, n, file="f"):
    return spark.createDataFrame(
        [(file, i, f"20150218101500-{i}") for i in range(n)], "file string, seq long, record_key string"
    )


def test_spread_four_and_seven(spark):
    got = replay.spread_event_times(_records(spark, 4)).orderBy("seq").collect()
    base = int(dt.datetime(2015, 2, 18, 10, 15, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert [r["event_ms"] - base for r in got] == [0, 225000, 450000, 675000]
    got7 = replay.spread_event_times(_records(spark, 7)).orderBy("seq").collect()
    assert got7[1]["event_ms"] - got7[0]["event_ms"] == 128571


def test_pacing_seven_rows_three_seconds(spark):
    paced = replay.pace_release(_records(spark, 7), seconds=3)
    counts = {r["release_second"]: r["rows"] for r in replay.release_counts(paced).collect()}
    assert counts == {1: 2, 2: 2, 3: 3}
    assert replay.release_batch(paced, 3).count() == 3


def _loop(rows, seconds):
    """The release loop: each second send queued div seconds_left."""
    sizes, left = [], rows
    for r in range(seconds, 0, -1):
        k = left // max(r, 1)
        sizes.append(k)
        left -= k
    return sizes


@settings(max_examples=12, deadline=None)
@given(st.integers(min_value=1, max_value=120), st.integers(min_value=1, max_value=50))
def test_pacing_matches_loop(spark, rows, seconds):
    paced = replay.pace_release(_records(spark, rows), seconds=seconds)
    counts = {r["release_second"]: r["rows"] for r in replay.release_counts(paced).collect()}
    want = {i + 1: k for i, k in enumerate(_loop(rows, seconds)) if k}
    assert counts == want
    assert sum(counts.values()) == rows  # rows are conserved


def test_landed_files_and_missing(spark, tmp_dir):
    """Segment names from the files actually landed in a folder, and the
    expected ones that are missing."""
    import os

    from tallyho.operators import segments

    for stamp in ("20150218100000", "20150218104500"):
        with open(os.path.join(tmp_dir, f"{stamp}.gkg.csv"), "w") as fh:
            fh.write("x\n")
    landed = segments.landed_files(spark.read.text(tmp_dir))
    assert sorted(r["file_name"] for r in landed.collect()) == [
        "20150218100000.gkg.csv", "20150218104500.gkg.csv"
    ]
    missing = segments.missing_segments(segments.expected_segments(landed), landed)
    assert sorted(r["file_name"] for r in missing.collect()) == [
        "20150218101500.gkg.csv", "20150218103000.gkg.csv"
    ]


def test_kafka_record_shape(spark):
    from tallyho.sources import sinks

    df = spark.createDataFrame([("k1", 3)], "name string, n long")
    out = sinks.kafka_records(df, "name", "n", "name-counts", partition=0)
    assert out.columns == ["key", "value", "topic", "partition"]
    assert tuple(out.first()) == ("k1", "3", "name-counts", 0)


def test_event_time_travels_in_a_header(spark):
    """What the topic sink is given, the topic source's reader gives back; a
    record of another producer keeps the broker's time."""
    from tallyho.sources import sinks

    t, broker = dt.datetime(2015, 2, 18, 10, 15, 0, 123456), dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([("k1", "v", t), ("k2", "v", None)], "key string, value string, ts timestamp")
    sent = sinks.kafka_records(df, "key", "value", "feed", event_time="ts")
    assert sent.schema["headers"].dataType.simpleString() == sinks.HEADERS_TYPE
    raw = sent.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(broker).alias("timestamp"), "headers",
    )
    got = {r["key"]: (r["value"], r["timestamp"]) for r in sinks.topic_records(raw).collect()}
    assert got == {"k1": ("v", t), "k2": ("v", broker)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=60), min_size=1, max_size=5))
def test_replay_conserves_rows_per_file(spark, sizes):
    """Several files at once: every file's rows are released exactly once
    within its seconds, and spread over its own 15 minutes."""
    rows = []
    for f, size in enumerate(sizes):
        stamp = f"2015021810{15 * f:02d}00" if f < 4 else "20150218110000"
        rows += [(stamp, i, f"{stamp}-{i}") for i in range(1, size + 1)]
    df = spark.createDataFrame(rows, "file string, seq long, record_key string")
    paced = replay.release_counts(replay.pace_release(df, seconds=7)).collect()
    per_file = {}
    for r in paced:
        assert 1 <= r["release_second"] <= 7
        per_file[r["file"]] = per_file.get(r["file"], 0) + r["rows"]
    want = {}
    for stamp, _, _ in rows:
        want[stamp] = want.get(stamp, 0) + 1
    assert per_file == want
    spread = replay.spread_event_times(df).collect()
    for r in spread:
        start = int(dt.datetime.strptime(r["file"][:12], "%Y%m%d%H%M").replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        assert start <= r["event_ms"] < start + 900_000
    assert len({(r["file"], r["event_ms"]) for r in spread}) == len(rows)


def test_compact_rebalances_and_keeps_rows(spark, tmp_dir):
    import os

    from tallyho.sources import sinks

    df = spark.range(0, 5000).repartition(40)  # many small pieces
    out = sinks.compact(df, os.path.join(tmp_dir, "c"))
    back = spark.read.parquet(out)
    assert back.count() == 5000 and back.agg(F.sum("id")).first()[0] == sum(range(5000))
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) < 40
    exact = sinks.compact(df, os.path.join(tmp_dir, "e"), files=3)
    assert len([f for f in os.listdir(exact) if f.endswith(".parquet")]) == 3
