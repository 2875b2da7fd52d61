"""Edge rows for the feed parser (hand-written 27-column lines)."""

import os

from tallyho.operators import topnames
from tallyho.sources import feed


def _line(names, date="20150218000000", rid="20150218000000-1", fields=27):
    cols = [""] * fields
    cols[0] = rid
    if fields > 1:
        cols[1] = date
    if fields > 23:
        cols[23] = names
    return "\t".join(cols)


def _write(tmp_dir, lines, raw_bytes=None):
    path = os.path.join(tmp_dir, "20150218000000.gkg.csv")
    with open(path, "wb") as fh:
        for ln in lines:
            fh.write(ln.encode("utf-8") + b"\n")
        for rb in raw_bytes or []:
            fh.write(rb + b"\n")
    return path


def _names(spark, path, strip="last", typed=False):
    if typed:
        arts = feed.articles_from_typed(feed.read_typed(spark, path))
    else:
        arts = feed.articles_from_lines(feed.read_lines(spark, path))
    rows = topnames.explode_names(arts, strip=strip, keep=("record_id",)).collect()
    out = {}
    for r in rows:
        out.setdefault(r["record_id"], []).append(r["name"])
    return {k: sorted(v) for k, v in out.items()}


CASES = {
    "plain": ("Ann Lee,5;Bob,9", ["Ann Lee", "Bob"]),
    "comma": ("Smith, John,12", ["Smith, John"]),
    "nooffset": ("Ann Lee", ["Ann Lee"]),
    "empties": ("Ann,1;;Bob,2;", ["Ann", "Bob"]),
    "noisebare": ("Type ParentCategory;null;Ann,1", ["Ann"]),
    "noiseoff": ("Type ParentCategory,123;Ann,1", ["Ann"]),
    "quote": ('"Quoted,7;Bob,1', ['"Quoted', "Bob"]),
}


def _case_lines():
    return [_line(v[0], rid=f"20150218000000-{k}") for k, v in CASES.items()] + [
        _line("", rid="20150218000000-empty")
    ]


def test_edge_rows_raw_lines(spark, tmp_dir):
    path = _write(tmp_dir, _case_lines())
    got = _names(spark, path)
    for k, (_, want) in CASES.items():
        assert got[f"20150218000000-{k}"] == sorted(want), k
    assert "20150218000000-empty" not in got


def test_edge_rows_typed_scan(spark, tmp_dir):
    path = _write(tmp_dir, _case_lines())
    got = _names(spark, path, typed=True)
    for k, (_, want) in CASES.items():
        assert got[f"20150218000000-{k}"] == sorted(want), k


def test_strip_first(spark, tmp_dir):
    path = _write(tmp_dir, [_line("Smith, John,12", rid="r1")])
    assert _names(spark, path, strip="first")["r1"] == ["Smith"]


def test_short_row_dropped_and_counted(spark, tmp_dir):
    path = _write(tmp_dir, [_line("Ann,1", rid="ok"), "r2\t20150218000000"])
    got = _names(spark, path)
    assert list(got) == ["ok"]
    rep = feed.line_report(feed.read_lines(spark, path)).first()
    assert rep["lines"] == 2 and rep["short_lines"] == 1


def test_bad_utf8_removed(spark, tmp_dir):
    raw = _line("An\udcffn,1", rid="bad").encode("utf-8", "surrogateescape")
    path = _write(tmp_dir, [], raw_bytes=[raw])
    assert _names(spark, path)["bad"] == ["Ann"]


def test_bad_date_is_dropped_from_daily_results(spark, tmp_dir):
    lines = [_line("Ann,1", date="abc", rid="x"), _line("Bob,1", rid="y"), _line("Cy,1", date="20150301000000", rid="z")]
    path = _write(tmp_dir, lines)
    for arts in (
        feed.articles_from_lines(feed.read_lines(spark, path)),
        feed.articles_from_typed(feed.read_typed(spark, path)),
    ):
        top = topnames.top_names_per_day(arts)
        rows = sorted((str(r["day"]), r["rank"], r["name"], r["n"]) for r in top.collect())
        assert rows == [("2015-02-18", 1, "Bob", 1), ("2015-03-01", 1, "Cy", 1)]
        assert [r["name"] for r in topnames.first_days(top, 1).collect()] == ["Bob"]
    assert feed.line_report(feed.read_lines(spark, path)).first()["undated_lines"] == 1


def test_names_are_cut_once(spark, tmp_dir):
    """Fields are found without cutting the line; names are cut once."""
    path = _write(tmp_dir, [_line("Ann,1;Bob,2")])
    arts = feed.articles_from_lines(feed.read_lines(spark, path))
    plan = topnames.explode_names(arts)._jdf.queryExecution().executedPlan().toString()
    # lines aren't cut at all, and the name list is cut once
    assert "split(value" not in plan and plan.count(", ;, -1)") == 1


def test_tie_at_rank_10(spark, tmp_dir):
    names = ";".join(f"N{c},{i}" for i, c in enumerate("KJIHGFEDCBA"))
    path = _write(tmp_dir, [_line(names)])
    arts = feed.articles_from_lines(feed.read_lines(spark, path))
    top = topnames.top_names_per_day(arts).orderBy("rank").collect()
    assert [r["name"] for r in top] == [f"N{c}" for c in "ABCDEFGHIJ"]
    assert [r["rank"] for r in top] == list(range(1, 11))


def test_lists_and_first_days(spark, tmp_dir):
    lines = [_line("Ann,1;Bob,2;Ann,3", date=f"201502{d:02d}000000", rid=f"r{d}") for d in range(10, 22)]
    path = _write(tmp_dir, lines)
    arts = feed.articles_from_lines(feed.read_lines(spark, path))
    top = topnames.top_names_per_day(arts)
    lists = topnames.top_lists(top).collect()
    assert {r["top_names"] for r in lists} == {"Ann:2;Bob:1"}
    first = topnames.first_days(top, days=10).select("day").distinct().count()
    assert first == 10


def test_feed_records_spread_per_segment(spark, tmp_dir):
    """The feeder keys each line by its record id and spreads a segment's
    lines over 15 minutes from the segment stamp, by sequence number."""
    from tallyho.operators import replay

    lines = [_line("Ann,1", rid=f"20150218101500-{i}") for i in (3, 1, 2, 4)]
    lines += [_line("Bob,1", rid="20150218103000-9"), _line("Cy,1", rid="nostamp-4")]
    path = _write(tmp_dir, lines)
    lines = feed.read_lines(spark, path)
    recs = replay.feed_records(lines).collect()
    assert [r["record_key"] for r in replay.rejected_lines(lines).collect()] == ["nostamp-4"]
    got = {r["key"]: r["event_ms"] for r in recs}
    base = 1424254500000  # 2015-02-18 10:15 UTC
    assert got == {
        "20150218101500-1": base,
        "20150218101500-2": base + 225000,
        "20150218101500-3": base + 450000,
        "20150218101500-4": base + 675000,
        "20150218103000-9": base + 900000,
    }
    assert all(r["value"].startswith(r["key"] + "\t") for r in recs)


def test_record_mentions_parse_stage(spark, tmp_dir):
    """Records -> one row per real name at the record's event time, with
    distinct mention ids (same parse rules as the batch path)."""
    import datetime as dt

    t = dt.datetime(2015, 2, 18, 10, 0)
    rows = [
        ("20150218100000-1", _line("Ann Lee,5;Bob,9;;null,3", rid="20150218100000-1"), t),
        ("20150218100000-2", _line("Smith, John,12;Ann Lee,1", rid="20150218100000-2"), t),
        ("20150218100000-3", _line("", rid="20150218100000-3"), t),
        ("20150218100000-4", "short\tline", t),
    ]
    recs = spark.createDataFrame(rows, "key string, value string, timestamp timestamp")
    got = feed.record_mentions(recs).collect()
    assert sorted((r["record_key"], r["name"]) for r in got) == [
        ("20150218100000-1", "Ann Lee"),
        ("20150218100000-1", "Bob"),
        ("20150218100000-2", "Ann Lee"),
        ("20150218100000-2", "Smith, John"),
    ]
    assert len({r["event_id"] for r in got}) == 4
    assert {r["ts"] for r in got} == {t}


def test_as_feed_typed_view(spark):
    import pytest
    from pyspark.errors import AnalysisException

    from tallyho.schema import FEED_COLUMNS, FEED_SCHEMA

    cols = list(reversed(FEED_COLUMNS))
    ddl = lambda t: ", ".join(
        f"`{c}` {t if c == 'SourceCollectionIdentifier' else 'string'}" for c in cols
    )
    row = tuple(7 if c == "SourceCollectionIdentifier" else f"v-{c}" for c in cols)
    typed = feed.as_feed(spark.createDataFrame([row], ddl("smallint")))
    assert typed.schema == FEED_SCHEMA  # reordered, smallint widened to int
    r = typed.first()
    assert r["SourceCollectionIdentifier"] == 7 and r["AllNames"] == "v-AllNames"
    text = tuple("7" if c == "SourceCollectionIdentifier" else v for c, v in zip(cols, row))
    with pytest.raises(AnalysisException):
        feed.as_feed(spark.createDataFrame([text], ddl("string")))


def test_top_pairs_nested(spark):
    top = spark.createDataFrame(
        [("d1", 2, "Bob", 3), ("d1", 1, "Ann", 5), ("d2", 1, "Cy", 1)],
        "day string, rank int, name string, n long",
    )
    got = {r["day"]: [(p["name"], p["n"]) for p in r["top"]] for r in topnames.top_pairs(top).collect()}
    assert got == {"d1": [("Ann", 5), ("Bob", 3)], "d2": [("Cy", 1)]}


def test_command_line(spark, tmp_dir, capsys):
    from tallyho.__main__ import main

    path = _write(tmp_dir, [_line("Ann,1;Bob,2", rid="20150218000000-1"), _line("Ann,3", rid="20150218000000-2")])
    out = os.path.join(tmp_dir, "out")
    assert main(["top-names", path, "--out", out], spark=spark) == 0
    rows = [(r["name"], r["n"], r["rank"]) for r in spark.read.parquet(out).orderBy("rank").collect()]
    assert rows == [("Ann", 2, 1), ("Bob", 1, 2)]
    assert main(["top-names", path, "--lines", "--k", "1"], spark=spark) == 0
    assert capsys.readouterr().out.strip() == "2015-02-18 [(Ann, 2)]"
