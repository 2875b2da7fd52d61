"""Near duplicates against all pairs of a small table."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tallyho.llm import components, neardup
from tallyho.llm.words import Texts, text_buffer
from tests.llm.common import edge_documents, edge_rows, lower, no_documents, prose, words


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: (len(a), root(i)) for i, a in sets if i is not None}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert found == brute(rows)
    for r in got:
        assert r.kept == (r.doc_id == r.component_id or r.doc_id is None)


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def test_edge_rows(spark):
    check(spark, [(r[0], r[1]) for r in edge_rows()])


def test_groups_of_copies(spark):
    """Copies edited a little to a lot around the threshold, exact copies,
    chains, and texts of one to six words."""
    rows, at = [], 1000
    for group in range(6):
        base = prose(group, 150 + 40 * group)
        for k in range(40):
            rows.append((at, edited(base, at, [0, 0.01, 0.02, 0.03][k % 4])))
            at -= 1
    chain = prose(77, 300).split()
    for k in range(12):  # each shares 0.8 with the next, the ends little
        rows.append((2000 + k, " ".join(chain[k * 20 : k * 20 + 120])))
    rows += [(3000 + k, " ".join(["a", "B", "c", "d", "e", "f"][: k % 7])) for k in range(20)]
    check(spark, rows)


def test_exact_threshold(spark):
    """Intersection 75 of union 100 links, 74 of 99 doesn't."""
    common = [f"c{i}" for i in range(79)]  # 75 shingles
    rows = [(1, " ".join([*common, *(f"x{i}" for i in range(25))])), (2, " ".join(common))]
    rows += [(3, " ".join(f"d{i}" for i in range(103))), (4, " ".join(f"d{i}" for i in range(78)))]
    check(spark, rows)
    assert brute(rows)[2][1] == 1 and brute(rows)[4][1] == 4


def test_empty_table(spark):
    assert neardup.near_duplicates(no_documents(spark)).collect() == []


def test_extra_columns(spark):
    got = neardup.near_duplicates(edge_documents(spark, extra=True)).count()
    assert got == len(edge_rows())


@pytest.mark.parametrize("size", [8, 60, 150, 1000, 5000, 40_000])
def test_sketch_keeps_the_threshold_and_drops_what_is_far(size):
    """Pairs at the threshold are within the limit at every size; pairs of
    similarity 0.6 are mostly not, from 60 to 5000 shingles."""
    rng = np.random.default_rng(size)

    def distance(j):
        union = rng.integers(0, 2**63, size).astype(np.uint64)
        common = -(-int(100 * j) * size // 100)
        cut = common + int(rng.integers(0, size - common + 1))
        a, b = union[:cut], np.concatenate([union[:common], union[cut:]])
        far = np.unpackbits(neardup.odd_sketch(a) ^ neardup.odd_sketch(b)).sum()
        return far, neardup.sketch_limit(float(len(a)), float(len(b)), np)

    assert all(far <= limit for far, limit in (distance(0.75) for _ in range(200)))
    if 60 <= size <= 5000:
        assert np.mean([far > limit for far, limit in (distance(0.6) for _ in range(200))]) > 0.9


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(0, 70)]
    edges += [(500, 501 + i) for i in range(300)]
    edges += [(1000 + i, 1000 + (i + 1) % 40) for i in range(40)] + [(9, 9), (3000, 3000)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = defaultdict(set)
    for r in components.components(df).collect():
        got[r.component].add(r.node)
    assert got == {0: set(range(71)), 500: set(range(500, 801)), 1000: set(range(1000, 1040))}


def test_long_text_is_hashed_in_blocks():
    import pyarrow as pa

    text = prose(3, 20_000)
    t = Texts(*text_buffer(pa.array([text])), True)
    (s,) = neardup.shingle_sets(t)
    assert len(s) == len(shingles(text))
    whole = (neardup._FACTORS[:, None] * s + neardup._OFFSETS[:, None]).min(axis=1)
    assert (neardup.minhash(s) == whole).all()
