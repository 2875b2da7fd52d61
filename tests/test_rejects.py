"""Lines by reason, split in one pass."""

import os

from tallyho.sources import rejects
from tallyho.schema import FEED_COLUMNS


def line(key, date, names="Ann,1", fields=len(FEED_COLUMNS)):
    cols = [""] * len(FEED_COLUMNS)
    cols[0], cols[1], cols[23] = key, date, names
    return "\t".join(cols[:fields])


LINES = [
    (line("20150218100000-1", "20150218100000"), []),
    (line("20150218100000-2", "20150218100000", fields=2), ["short"]),
    (line("bad-3", "20150218100000"), ["no_stamp"]),
    (line("bad-4", "x", fields=5), ["short", "no_stamp"]),
    (line("20150218100000-5", "soon"), ["undated"]),
    (line("bad-6", ""), ["no_stamp", "undated"]),
    ("", ["short", "no_stamp"]),
    (line("20150218100000-7", "20150218100000", "B\udcffb,1"), ["bad_bytes"]),
    (line("bad-8", "20150218100000", "B\udcffb,1"), ["no_stamp", "bad_bytes"]),
]


def test_reasons_and_channels(spark, tmp_dir):
    source, out = os.path.join(tmp_dir, "x.txt"), os.path.join(tmp_dir, "out")
    with open(source, "wb") as f:
        f.write(b"".join(x.encode("utf-8", "surrogateescape") + b"\n" for x, _ in LINES))
    counted = rejects.split_lines(spark.read.text(source), out)
    want = {r: sum(r in reasons for _, reasons in LINES) for r in rejects.REASONS}
    bad = [r for _, r in LINES if set(r) - {"bad_bytes"}]
    assert counted == {"lines": len(LINES), "rejects": len(bad), **want}
    held = rejects.read_channel(spark, out, rejects.REJECTS).collect()
    assert sorted(r["reasons"] for r in held) == sorted(bad)
    assert rejects.read_channel(spark, out, rejects.LINES).count() == 2


def test_no_lines(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    counted = rejects.split_lines(spark.createDataFrame([], "value string"), out)
    assert set(counted.values()) == {0}
    assert rejects.read_channel(spark, out, rejects.REJECTS).count() == 0
