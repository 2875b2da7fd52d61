"""The n-gram model against one kept in dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyho.llm import lm
from tests.conftest import SF_SMALL
from tests.llm.common import edge_documents, lower, no_documents, words, write_tables

END = object()


def tokens(text):
    return [*words(lower(text)), END]


class Plain:
    """Modified Kneser-Ney with counts in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.words = Counter(w for t in texts for w in tokens(t))
        counts = {order: Counter()}
        for t in texts:
            ts = [None] * (order - 1) + tokens(t)
            counts[order].update(tuple(ts[i : i + order]) for i in range(len(ts) - order + 1))
        for k in range(order - 1, 0, -1):
            counts[k] = Counter()
            for g, c in counts[k + 1].items():
                counts[k][g[1:]] += c if g[1] is None else 1
        self.counts = counts
        self.contexts = {}
        self.discounts = {}
        for k, own in counts.items():
            n = Counter(own.values())
            self.discounts[k] = lm.discounts(*(n[i] for i in (1, 2, 3, 4)))
            by = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in own.items():
                by[g[:-1]][0] += c
                by[g[:-1]][min(c, 3)] += 1
            self.contexts[k] = by

    def p(self, gram):
        k = len(gram)
        below = self.p(gram[1:]) if k > 1 else 1 / (len(self.words) + 1)
        total, *kinds = self.contexts[k].get(gram[:-1], [0])
        if not total:
            return below
        d = self.discounts[k]
        c = self.counts[k].get(gram, 0)
        own = c - (d[min(c, 3) - 1] if c else 0)
        return own / total + sum(x * n for x, n in zip(d, kinds, strict=True)) / total * below

    def score(self, text):
        ts = [None] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(ts[i : i + self.order]))) for i in range(len(ts) - self.order + 1))


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_plain_model(spark, order):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()
    docs = spark.createDataFrame(rows)
    training = docs.where(~lm.held_out(F.col("doc_id")))
    model = lm.train(training.select("text"), order, shard_bytes=20_000)
    plain = Plain([r.text for r in rows if not is_held_out(r.doc_id)], order)
    assert model.vocabulary.n_words == len(plain.words)
    assert model.vocabulary.n_tokens == sum(plain.words.values())
    for r in lm.score(docs, model).collect():
        ts = tokens(r.row.text)
        assert r.n_tokens == len(ts)
        assert r.n_known == sum(t in plain.words for t in ts)
        assert r.score == pytest.approx(plain.score(r.row.text), rel=1e-9)


def test_buckets_and_shards_do_not_change_scores(spark, monkeypatch):
    """Many buckets in a shard, portions of a few texts, texts of other alphabets."""
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(80).collect()
    docs = spark.createDataFrame(rows).repartition(3)
    monkeypatch.setattr(lm, "MIN_SHARDS", 2)
    monkeypatch.setattr(lm, "HOLD", 500)
    model = lm.train(docs.select("text"), 3, shard_bytes=10**6, bucket_bytes=2_000)
    assert lm.Ranges.of(200_000, 10**6, 2_000).inner_bits > 4
    plain = Plain([r.text for r in rows], 3)
    for r in lm.score(docs, model).collect():
        assert r.score == pytest.approx(plain.score(r.row.text), rel=1e-9)


@pytest.mark.parametrize("id_bits", [3, 20, 22, 31, 40])
def test_blocks_round_trip(id_bits):
    rng = np.random.default_rng(id_bits)
    kind = np.int32 if id_bits < 32 else np.int64
    ids = [rng.integers(0, 2**id_bits, 3000).astype(kind) for _ in range(3)]
    ids[0][:1000] = ids[0][0]
    ids[1][:500] = ids[1][0]
    ids = [np.concatenate([i, i[:700]]) for i in ids]
    n = rng.integers(1, 5, 3700)
    n[5] = 2**40
    expected = Counter()
    for *g, c in zip(*ids, n, strict=True):
        expected[tuple(int(x) for x in g)] += int(c)
    numbers, (times,) = lm._counted(list(ids), id_bits)
    assert Counter(zip(*(i.tolist() for i in ids), strict=True)) == {
        tuple(g): c for *g, c in zip(*(i.tolist() for i in numbers), times.tolist(), strict=True)
    }
    found, values = lm._distinct(ids, [n], id_bits)
    back, (count,) = lm._decode(lm._encode(found, values), 3)
    got = list(zip(*(i.tolist() for i in back), strict=True))
    assert got == sorted(expected) and count.tolist() == [expected[g] for g in got]


def test_large_shards_are_written_in_ranges(tmp_path):
    """A shard of a key range in eight parts, with index, cut keys, values apart."""
    rng = np.random.default_rng(5)
    low, bits = 3 << 60, 60
    keys = np.unique(low + rng.integers(0, 2**bits, 200_000)).astype(np.uint64)
    values = [np.minimum(rng.zipf(1.5, len(keys)), 10**9), rng.integers(0, 2, len(keys))]
    raw = rng.integers(0, 10**7, len(keys))
    writer = lm.Writer(str(tmp_path), "x", 3, low, bits, 8)
    part = (keys - np.uint64(low)) >> np.uint64(bits - 3)
    for k in range(8):
        own = part == k
        writer.add(keys[own], [v[own] for v in values], [raw[own]])
    writer.finish()
    arrays = lm.Arrays(str(tmp_path), "x")
    assert arrays.shard(3).dropped > 0
    asked = np.concatenate([rng.permutation(keys), keys[:50], rng.integers(0, 2**64, 50_000, np.uint64)])
    place, got = arrays.look(asked, 4, 3)
    at = np.searchsorted(keys, asked)
    at[at == len(keys)] = 0
    there = keys[at] == asked
    assert (place == np.where(there, at, -1)).all()
    for v, g in zip([*values, raw], got, strict=True):
        assert (g == np.where(there, v[at], 0)).all()


def test_distribution_sums_to_one():
    texts = ["a b a c b a", "b c", "a a a b", "c a b c d"]
    for order in (2, 3):
        plain = Plain(texts, order)
        for context in ([None] * (order - 1), ["a"] * (order - 1), ["unseen"] * (order - 1)):
            total = sum(plain.p((*context, w)) for w in plain.words) + plain.p((*context, "unknown"))
            assert total == pytest.approx(1)


def test_held_out_text_is_better_than_shuffled(spark):
    """The model has learnt word order: held-out texts score above the same
    words in reverse."""
    docs = spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet").select("doc_id", "text")
    model = lm.train(docs.where(~lm.held_out(F.col("doc_id"))).select("text"))
    held = docs.where(lm.held_out(F.col("doc_id"))).withColumn(
        "back", F.array_join(F.reverse(F.split(F.lower("text"), r"\s+")), " ")
    )
    ahead = {r.row.doc_id: r.score for r in lm.score(held, model).collect()}
    back = {r.row.doc_id: r.score for r in lm.score(held, model, "back").collect()}
    assert sum(ahead.values()) > sum(back.values())


def test_registered_model_tells_two_word_contexts_apart(spark):
    """Words that follow one word equally often, but not the two before."""
    texts = spark.createDataFrame([("a b c",), ("x b d",)] * 20, "text string")
    model = lm.train(texts)
    docs = spark.createDataFrame([("a b c",), ("a b d",), ("x b d",), ("x b c",)], "text string")
    got = {r.row.text: r.score for r in lm.score(docs, model).collect()}
    assert got["a b c"] > got["a b d"] + 0.5 and got["x b d"] > got["x b c"] + 0.5


def test_query_and_edge_cases(spark, tmp_dir):
    from tallyho.llm.queries import op2_lm_scoring

    got = op2_lm_scoring(spark, write_tables(spark, tmp_dir, edge_documents(spark, extra=True))).collect()
    docs = edge_documents(spark).collect()
    assert len(got) == len(docs)
    training = [r.text for r in docs if not is_held_out(r.doc_id)]
    plain = Plain(training, lm.ORDER)
    v, n = len(plain.words), sum(plain.words.values())
    expected = sorted(
        (
            str(r.doc_id),
            is_held_out(r.doc_id),
            len(tokens(r.text)),
            sum(t in plain.words for t in tokens(r.text)),
            n,
            round(sum(math.log10((plain.words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r.text)), 5),
            round(plain.score(r.text), 5),
        )
        for r in docs
    )
    assert expected == sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5))
        for r in got
    )


def test_empty_tables(spark, tmp_dir):
    from tallyho.llm.queries import op2_lm_scoring

    assert op2_lm_scoring(spark, write_tables(spark, tmp_dir, no_documents(spark))).collect() == []
    model = lm.train(no_documents(spark).select("text"))
    got = lm.score(edge_documents(spark).select("doc_id", "text"), model).collect()
    assert {(r.n_known, r.score, r.base_score) for r in got} == {(0, 0.0, 0.0)}


def test_arrays_round_trip(tmp_path):
    keys = np.array([3, 9, 2**63 + 5], np.uint64)
    lm._save(str(tmp_path), "x", 0, keys, [np.array([1, 300, 2]), np.array([0, 0, 2**40])])
    place, values = lm.Arrays(str(tmp_path), "x").find(
        np.array([9, 4, 2**63 + 5, 9], np.uint64), np.array([0, 0, 0, 1]), 2
    )
    assert place.tolist() == [1, -1, 2, -1]
    assert [v.tolist() for v in values] == [[300, 0, 2, 0], [0, 0, 2**40, 0]]


@pytest.mark.parametrize("share", [0, 0.01, 0.5])
def test_few_large_values_are_kept_apart(tmp_path, share):
    rng = np.random.default_rng(1)
    n = 5000
    values = rng.integers(0, 256, n)
    large = rng.random(n) < share
    values[large] = rng.integers(255, 10**9, large.sum())
    keys = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
    lm._save(str(tmp_path), "x", 3, keys, [values, values * 0 + 255])
    order = rng.permutation(n)
    place, got = lm.Arrays(str(tmp_path), "x").find(keys[order], np.full(n, 3), 2)
    assert (place == order).all() and (got[0] == values[order]).all() and (got[1] == 255).all()
