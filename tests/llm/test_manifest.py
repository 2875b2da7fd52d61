"""Operator 12 against a plain tree, and its parts."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyho.llm import manifest, queries
from tests.llm.common import SCHEMA, edge_documents, edge_rows, lower, no_documents, write_tables


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain(rows):
    """The contract's rows of (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for d, t, lang, s, n in rows:
        tampered = d is not None and zlib.crc32(str(d).encode()) % 3 == 0 and t is not None
        leaf = H(*map(field, (d, s, lang, n, t)))
        other = H(*map(field, (d, s, lang, n, lower(t)))) if tampered else leaf
        groups.setdefault(lang, []).append((d, leaf, other))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1:]))
        trees[lang] = plain_tree([x[1] for x in groups[lang]])
    top = plain_tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (d, leaf, now) in enumerate(groups[lang]):
            siblings = []
            for tree, place in ((trees[lang], i), (top, k)):
                for level in tree[:-1]:
                    run = level[place // 8 * 8 :][:8]
                    slot = place % 8
                    siblings += run[:slot] + run[slot + 1 :]
                    now = H(*run[:slot], now, *run[slot + 1 :])
                    place //= 8
            root = top[-1][0]
            out.append((d, leaf, trees[lang][-1][0], root, H(*siblings), now, now == root))
    return out


def run(spark, tmp_dir, docs):
    return queries.op12_merkle_manifest(spark, write_tables(spark, tmp_dir, docs))


def same(got, rows):
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, plain(rows)))


def test_edge_rows(spark, tmp_dir):
    same(run(spark, tmp_dir, edge_documents(spark, extra=True)), edge_rows())


def test_no_rows(spark, tmp_dir):
    assert run(spark, tmp_dir, no_documents(spark)).count() == 0


def test_one_row(spark, tmp_dir):
    rows = [(3, "One", None, None, 3)]
    got = run(spark, tmp_dir, spark.createDataFrame(rows, SCHEMA))
    same(got, rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_many_blocks(spark, tmp_dir, monkeypatch, levels):
    """Small blocks, so that trees of groups, and of groups' roots, need several
    rounds: 700 rows, one group with half of them, 90 groups."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(manifest, "_SIZE", 8**levels)
    r = random.Random(12)
    rows = [(k, f"Text {k}", "en" if k % 2 else f"l{r.randrange(90)}", "s", k) for k in range(700)]
    rows += [(None, None, "é", None, None), (5, "again", "en", None, 1), (5, "Again", "en", None, 1)]
    same(run(spark, tmp_dir, spark.createDataFrame(rows, SCHEMA)), rows)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 100])
def test_fold_resumes_states(n):
    nodes = [H(str(k)) for k in range(n)]
    levels = manifest.levels_of(0, n)
    tree = manifest.build(nodes, levels)
    want = plain_tree(nodes)
    assert [[p.digest for p in level] for level in tree] == want[1:]
    for k in range(n):
        now, place = H("new"), k
        for level in tree:
            place, slot = divmod(place, manifest.FAN)
            parent = level[place]
            assert len(parent.states) == len(parent.children)
            now = parent.fold(slot, now)
        changed = [*nodes[:k], H("new"), *nodes[k + 1 :]]
        assert now == plain_tree(changed)[-1][0]


def test_levels_of_blocks():
    full = manifest.FAN**manifest.BLOCK_LEVELS
    assert manifest.levels_of(0, 1) == 0 and manifest.levels_of(3, 1) == manifest.BLOCK_LEVELS
    assert manifest.levels_of(0, full) == manifest.levels_of(1, full) == manifest.BLOCK_LEVELS
    assert manifest.levels_of(0, 9) == 2


def test_any_columns(spark):
    """Other names, a decoy column, and rows that come back whole."""
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "c", "x")], "idx int, `digest` string, `grp.x` string")
    made = manifest.manifest(df, ["idx", "digest"], "idx", "grp.x", keep=df.columns)
    got = manifest.verified(made).collect()
    assert len(got) == 3 and all(r["verified"] for r in got)
    assert {r["row"]["idx"]: r["leaf"] for r in got}[2] == H(field(2), field(None))
    made = manifest.manifest(df, ["idx", "digest"], "idx", "grp.x", F.col("idx") == 3, {"digest": F.lit("z")})
    assert {r["row"]["idx"]: r["verified"] for r in manifest.verified(made).collect()} == {1: True, 2: True, 3: False}
