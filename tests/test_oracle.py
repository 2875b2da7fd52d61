"""Every query on the feed and the events against its DuckDB twin (sf0.001).

The training-data queries have theirs in tests/llm."""

import pytest

import __spark_entry__ as entry
from tallyho.plans import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert res["cols_match"], res
    assert res["values_match"], res


def test_entry_runs(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    df = entry.entry(spark)
    assert df.columns == ["day", "rank", "name", "n"]
    assert df.count() > 0


def test_edge_rows_are_exercised(con):
    """The fixtures hold what the operators must handle."""
    report = con.execute(SQL["feed_line_report"]).fetchone()
    assert all(report[:3]), report
    noise = con.execute(f"SELECT sum(noise_names) FROM ({SQL['noise_filtered']})").fetchone()
    assert noise[0] > 0
    assert con.execute(f"SELECT count(*) FROM ({SQL['feed_rejects']})").fetchone()[0] > 0
    polls = con.execute(f"SELECT poll, count(*) FROM ({SQL['segment_polls']}) GROUP BY poll").fetchall()
    assert len(polls) == 2 and all(n for _, n in polls)
