"""Token counts by trees against whole encodings."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyho.llm import tokencounts as tc
from tests.conftest import SF_SMALL
from tests.llm.common import edge_documents, edge_rows, no_documents, write_tables


@pytest.fixture(scope="module")
def count():
    with open(tc.VOCABULARY, "rb") as f:
        return tc.load_counter(f.read())


TEXT = st.text(alphabet=st.sampled_from("ab'st 1\n\t\x85  é世,.<|endoftext|>"), max_size=120)


@settings(max_examples=300, deadline=None)
@given(text=TEXT, cuts=st.lists(st.integers(0, 120), max_size=6), new=st.lists(TEXT, min_size=3, max_size=3))
def test_tree_counts_equal_whole_encoding(count, text, cuts, new):
    lengths, tree = tc.build(text, count, leaf=8)
    assert sum(lengths) == len(text) and tree[1] == count(text)
    at = sorted(min(c, len(text)) for c in cuts)
    edits = [(at[i], at[i + 1], new[i // 2]) for i in range(0, len(at) - 1, 2)]
    got, new_lengths, new_tree, _ = tc.edit(text, lengths, tree, edits, count, leaf=8)
    expected, done = "", 0
    for s, e, r in edits:
        expected += text[done:s] + r
        done = e
    expected += text[done:]
    assert got == expected
    assert new_tree[1] == count(expected)
    assert sum(new_lengths) == len(expected)
    # The leaves still tell their own counts, and a second edit can follow.
    leaf_at = 0
    for n, c in zip(new_lengths, new_tree[len(new_tree) // 2 :], strict=False):
        assert c == count(expected[leaf_at : leaf_at + n])
        leaf_at += n
    again = tc.edit(got, new_lengths, new_tree, [(0, min(3, len(got)), "zz")], count, leaf=8)
    assert again[2][1] == count("zz" + got[3:])


def test_edit_encodes_only_what_it_touches(count):
    r = random.Random(2)
    text = " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(20_000))
    lengths, tree = tc.build(text, count)
    calls = []
    got = tc.edit(text, lengths, tree, [(50_000, 50_004, "changed words")], lambda x: calls.append(x) or count(x))
    assert got[3] < 3 * tc.LEAF and sum(map(len, calls)) == got[3]
    assert got[2][1] == count(got[0])


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))


def checked_edit(count, state, edits):
    text, lengths, tree = state
    expected, done = "", 0
    for s, e, new in edits:
        expected, done = expected + text[done:s] + new, e
    got = tc.edit(text, lengths, tree, edits, count)
    assert got[0] == expected + text[done:] and sum(got[1]) == len(got[0]) and got[2][1] == count(got[0])
    return got


def test_tree_grows_and_shrinks(count):
    """A page of one leaf grows to a million characters, is edited, and shrinks."""
    r = random.Random(3)
    state = ("a few words", *tc.build("a few words", count))
    long = prose(r, 160_000)
    *state, encoded = checked_edit(count, state, [(5, 6, long)])
    assert len(state[1]) > 900 and max(state[1]) <= 2 * tc.LEAF
    *state, encoded = checked_edit(count, state, [(500_000, 500_003, "x")])
    assert encoded <= 6 * tc.LEAF
    *state, encoded = checked_edit(count, state, [(1000, len(state[0]) - 1000, "")])
    assert len(state[1]) <= 4 and encoded <= 6 * tc.LEAF
    *state, encoded = checked_edit(count, state, [(0, len(state[0]), "")])
    assert state == ["", [0], [0, 0]] and encoded == 0
    *state, encoded = checked_edit(count, state, [(0, 0, "new words")])
    assert state[1] == [9]


def test_leaves_stay_bounded_after_many_edits(count):
    r = random.Random(4)
    text = prose(r, 3000)
    state = (text, *tc.build(text, count))
    for _ in range(120):
        at = sorted(r.sample(range(len(state[0]) + 1), 4))
        edits = [(at[0], min(at[1], at[0] + r.choice([0, 3, 2000])), prose(r, r.choice([0, 1, 400]))), (at[2], at[2], "y ")]
        edits = [e for e in edits if e[1] <= at[2] or e[0] >= at[2]]
        *state, _ = checked_edit(count, tuple(state), edits)
        assert max(state[1]) <= 2 * tc.LEAF + 10
        # Small leaves beside each other don't pile up.
        assert len(state[1]) <= 4 * len(state[0]) / tc.LEAF + 4 + 120
    for _ in range(20):
        at = r.randrange(len(state[0]))
        *state, encoded = checked_edit(count, tuple(state), [(at, at + 2, "ab")])
        assert encoded <= 3 * 2 * tc.LEAF + 100


def test_query(spark, tmp_dir, count):
    from tallyho.llm.queries import op5_token_counts

    masked = re.compile(r"[0-9]{7,}|[\w.+-]+@[\w-]+\.[\w.-]+")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op5_token_counts(spark, SF_SMALL).collect()
    assert len(got) == len(texts) and sum(r.n_edits for r in got) > 5
    for r in got:
        assert r.n_tokens == count(texts[r.doc_id])
        assert r.n_tokens_after == count(masked.sub("<masked>", texts[r.doc_id]))
        assert r.n_edits == len(masked.findall(texts[r.doc_id]))
    got = op5_token_counts(spark, write_tables(spark, tmp_dir, edge_documents(spark, extra=True))).collect()
    assert sorted(r.n_tokens for r in got) == sorted(count(r[1] or "") for r in edge_rows())
    empty = op5_token_counts(spark, write_tables(spark, tmp_dir, no_documents(spark)))
    assert empty.collect() == []


def test_row_keeps_clashing_columns(spark):
    docs = edge_documents(spark, extra=True)
    got = tc.edit_trees(tc.build_trees(docs), lambda t: [(0, 1, "")])
    assert got.select("row.*").columns == docs.columns
    kept = {r.row.doc_id: r.new_text for r in got.collect() if r.row.doc_id in (2, 4, 5)}
    assert kept == {2: "", 4: "ne", 5: "ne two\x0bthree\nfour four"}
