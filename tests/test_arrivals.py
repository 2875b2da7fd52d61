"""Landed segments as a stream: offsets, late segments, restarts."""

import os

import pytest

from tallyho.sources import arrivals, sinks
from tallyho.streaming import runner


def name(k):
    return f"2015021{8 + k // 96}{k % 96 // 4:02d}{k % 4 * 15:02d}00.gkg.csv"


MARK = name(3)


def slots(*ks):
    return {arrivals.slot_of(name(k)) for k in ks}


def test_names():
    assert arrivals.name_of(arrivals.slot_of(name(95))) == name(95)
    assert arrivals.slot_of(f"file_name={name(7)}") == arrivals.slot_of(name(7))
    for other in ("20150218000700.gkg.csv", "20150218000000.csv", "x20150218000000.gkg.csv", "20159918000000.gkg.csv", "_SUCCESS"):
        assert arrivals.slot_of(other) is None


def test_offsets():
    zero = {"after": MARK, "mark": MARK, "missing": []}
    assert arrivals.next_offset(MARK, slots(0, 3)) == zero and arrivals.offered(zero, zero) == []
    one = arrivals.next_offset(MARK, slots(2, 3, 4, 5, 9, 97))
    assert one["mark"] == name(97) and len(one["missing"]) == 2
    assert arrivals.offered(zero, one) == [(name(k), False) for k in (4, 5, 9, 97)]
    two = arrivals.next_offset(MARK, slots(4, 5, 7, 9, 12, 97, 98))
    assert arrivals.offered(one, two) == [(name(7), True), (name(12), True), (name(98), False)]
    # A batch that spans both offers each once; one that is repeated, the same.
    assert sorted(arrivals.offered(zero, two)) == [(name(k), False) for k in (4, 5, 7, 9, 12, 97, 98)]
    three = arrivals.next_offset(MARK, slots(*range(4, 99)))
    offers = [x for a, b in ((zero, one), (one, two), (two, three)) for x, _ in arrivals.offered(a, b)]
    assert sorted(offers) == sorted(name(k) for k in range(4, 99))


def test_bad_mark():
    with pytest.raises(ValueError):
        arrivals.SegmentReader({"path": "/tmp", "mark": "yesterday"})
    with pytest.raises(ValueError):
        arrivals.local_folder("s3a://bucket/feed")


def land(spark, folder, *ks):
    rows = [(name(k), f"line {j} of {k}") for k in ks for j in range(k % 3 + 1)] + [(None, "nowhere")]
    return sinks.land_segments(spark.createDataFrame(rows, "file_name string, line string"), folder)


def test_landed_files(spark, tmp_dir):
    assert land(spark, tmp_dir, 4, 5, 6) == 3
    assert sorted(os.listdir(tmp_dir)) == [name(k) for k in (4, 5, 6)]
    with open(os.path.join(tmp_dir, name(5))) as f:
        assert f.read() == "line 0 of 5\nline 1 of 5\nline 2 of 5\n"


def test_each_segment_once_over_restarts(spark, tmp_dir):
    """Four runs from one checkpoint: nothing there, some, late and new ones, nothing new."""
    folder, checkpoint, out = (os.path.join(tmp_dir, x) for x in ("landing", "checkpoint", "out"))
    seen = []
    for ks in ((), (2, 4, 5, 8), (6, 9), ()):
        if ks:
            land(spark, folder, *ks)
        query = (
            arrivals.arriving_segments(spark, folder, MARK)
            .writeStream.foreachBatch(runner.batch_writer(out))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        rows = spark.read.schema("file_name string, path string, late boolean").parquet(out).collect() if os.path.exists(out) else []
        seen.append(sorted((r["file_name"], r["late"]) for r in rows))
        assert all(os.path.exists(r["path"]) for r in rows)
    two = [(name(k), False) for k in (4, 5, 8)]
    assert seen == [[], two, sorted([*two, (name(6), True), (name(9), False)]), sorted([*two, (name(6), True), (name(9), False)])]
