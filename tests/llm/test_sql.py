"""Queries of the operators and the pipeline against their DuckDB twins."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck, duck_rows
from tests.llm.common import write_tables
from tests.llm.test_urlfilter import judged, small_web

NAMES = sorted(n for n in entry.oracle_sql() if n == "pipeline" or n.startswith("op"))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name], con)
    assert res["cols_match"], res
    assert res["values_match"], res


def duck_table(name, columns, rows):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE TABLE {name} ({columns})")
    con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con


def chain_of_hosts():
    """A path of 60 hosts from a blocked one, and many seeds without links."""
    pages = [(k, f"http://lone{k}.{('org', 'com')[k % 2]}/de/{k}", None) for k in range(300)]
    pages += [(2000, "http://bad.com/de/1", "")]
    link = '<a href="http://{}/">'.format
    return pages + [(2000 + k, f"http://c{k}.io/", link("bad.com" if k == 1 else f"c{k - 1}.io")) for k in range(1, 61)]


@pytest.mark.parametrize("pages", [small_web(), chain_of_hosts()])
def test_url_twin_follows_links(pages):
    """The SQL twin on webs with links between hosts."""
    from tallyho.llm import urlfilter

    con = duck_table("pages", "page_id BIGINT, url VARCHAR, html VARCHAR", pages)
    columns, rows = duck_rows(con, entry.oracle_sql()["op9_url_filters"])
    order = [columns.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    want = judged(pages, urlfilter.RULES)
    assert sorted((tuple(r[i] for i in order) for r in rows), key=str) == want
    assert any(r[3] is None and r[4] == "block" for r in want)


def test_quality_twin_rejects_hosts(spark, tmp_dir):
    """The SQL twin, the operator and the plain version where hosts are rejected, and
    clean documents with them."""
    from tests.llm import test_quality

    rows = test_quality.hosts_of_all_kinds()
    con = duck_table("documents", "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT", rows)
    columns, got = duck_rows(con, entry.oracle_sql()["op8_quality_rules"])
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = test_quality.judged([(r[0], r[1], r[3]) for r in rows])
    assert sorted((tuple(r[columns.index(c)] for c in names) for r in got), key=str) == want
    assert any(not r[-1] and not r[-2] for r in want)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert test_quality.query(spark, write_tables(spark, tmp_dir, docs)) == want
