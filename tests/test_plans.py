"""Plan checks: no Python UDF on the batch paths, top-k cut before the
shuffle, pruned scans."""

import pytest

from tallyho.plans import QUERIES
from tests.conftest import SF_SMALL

# every registered batch query (the stream queries run a stateful Python
# processor by design)
STREAMS = {
    "feed_stream_top", "hourly_sliding_counts", "stateful_trailing", "stateful_changelog", "board_evictions",
    "stream_board",
}
BATCH = sorted(set(QUERIES) - STREAMS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, (name, node)


def test_top_k_partial_before_shuffle(spark):
    df = QUERIES["top_names_per_day"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_scan_reads_two_columns(spark):
    df = QUERIES["top_names_per_day"](spark, SF_SMALL)
    text = _plan(df)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_board_reads_only_the_last_hour(spark):
    """The time filter reaches the scan, and no window runs over the history."""
    text = _plan(QUERIES["latest_per_name"](spark, SF_SMALL))
    assert "GreaterThan(ts," in text and "Window" not in text
