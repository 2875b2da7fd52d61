"""Line dedup against a plain version."""

from collections import defaultdict

from tallyho.llm import linededup
from tests.conftest import SF_SMALL
from tests.llm.common import edge_documents, edge_rows, no_documents, prose, words, write_tables


def cleaned(rows):
    """(doc_id, n_lines, n_dropped, text) of (doc_id, text, host) rows."""
    pages, on = defaultdict(set), defaultdict(set)
    for _, t, h in rows:
        pages[h].add(t)
        for line in (t or "").split("\n"):
            if words(line):
                on[h, line].add(t)
    bad = {k for k, p in on.items() if len(p) >= 5 and len(p) > linededup.MAX_RATIO * len(pages[k[0]])}
    out = []
    for i, t, h in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if (h, x) not in bad]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if t is not None else None))
    return sorted(out, key=str)


def query(spark, folder):
    from tallyho.llm.queries import op3_line_dedup

    df = op3_line_dedup(spark, folder)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    return sorted(map(tuple, df.collect()), key=str)


def test_edge_rows(spark, tmp_dir):
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    got = query(spark, write_tables(spark, tmp_dir, edge_documents(spark, extra=True)))
    assert got == cleaned(rows)
    dropped = {r[0] for r in got if r[2]}
    assert dropped == {20 + k for k in range(12)}  # the shared footer, and no copied page


def test_hosts_have_their_own_boilerplate(spark, tmp_dir):
    rows = []
    for k in range(200):
        host = ["big", "big", "small", None][k % 4]
        text = "\n".join([prose(k, 9), "menu of big" if k % 3 else "about us", prose(1000 + k % 50, 3), " ", "", "all rights"])
        rows.append((k, text, "en", host, 1))
    rows += [(900 + k, "all rights", "en", "small", 1) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = query(spark, write_tables(spark, tmp_dir, docs))
    assert got == cleaned([(r[0], r[1], r[3]) for r in rows])
    assert {r[3] for r in got if r[0] >= 900} == {""}


def test_real_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet").collect()]
    assert query(spark, f"{SF_SMALL}/../sf0.01") == cleaned(rows)


def test_empty_table_and_clashing_columns(spark, tmp_dir):
    assert query(spark, write_tables(spark, tmp_dir, no_documents(spark))) == []
    docs = edge_documents(spark, extra=True)
    got = linededup.drop_boilerplate(docs).select("row.*")
    assert got.columns == docs.columns and sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
