"""The mix against a plain version."""

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyho.llm import mixing
from tests.conftest import SF_SMALL
from tests.llm.common import edge_documents, edge_rows, no_documents, words, write_tables


def targets(sizes):
    """By repeated sharing: whoever is above the limit is set to it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        unit = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if unit * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: unit * weight[s] for s in free}
        fixed |= {s: 3 * sizes[s] for s in over}


def quality(text):
    if not text:
        return 0.1 if text is None else 1.0
    return max(0.1, 1 - 9 * sum(text.count(c) for c in mixing.SYMBOLS) / len(text))


def mixed(rows):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source)."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    goal = targets(sizes)
    own = defaultdict(list)
    for i, t, s in rows:
        u = (int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        own[s].append((-math.log(u) / quality(t), -1 if i is None else i, len(words(t)), i))
    out = []
    for s, docs in own.items():
        epochs = math.floor(goal[s] / sizes[s]) if sizes[s] else 0
        rest, before = goal[s] - epochs * sizes[s], 0
        for _, _, size, i in sorted(docs):
            more = size > 0 and 2 * before + size < 2 * rest
            before += size
            out.append((i, size, sizes[s], round(goal[s], 6), size * (epochs + more)))
    return sorted(out, key=str)


def query(spark, folder):
    from tallyho.llm.queries import op1_mixing

    got = op1_mixing(spark, folder).collect()
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got), key=str)


def test_edge_rows(spark, tmp_dir):
    folder = write_tables(spark, tmp_dir, edge_documents(spark, extra=True))
    assert query(spark, folder) == mixed([(r[0], r[1], r[3]) for r in edge_rows()])


def test_real_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet").collect()]
    got = query(spark, f"{SF_SMALL}/../sf0.01")
    assert got == mixed(rows) == query(spark, f"{SF_SMALL}/../sf0.01")
    taken, goal, longest = defaultdict(int), {}, max(len(words(t)) for _, t, _ in rows)
    source = {i: s for i, _, s in rows}
    for i, size, _, target, took in got:
        taken[source[i]] += took
        goal[source[i]] = target
        assert took <= 3 * size
    assert all(abs(taken[s] - goal[s]) <= longest / 2 for s in goal)
    assert sum(goal.values()) == pytest.approx(sum(len(words(t)) for _, t, _ in rows))


def test_limits_are_reshared(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 5, "é": 300, "Z": 7, None: 40}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    for s, t in targets(sizes).items():
        assert got[s] == pytest.approx(t)
        assert got[s] <= 3 * sizes[s]


def test_better_documents_are_taken_more_often(spark):
    """Inclusion follows the quality weights as for Efraimidis-Spirakis keys."""
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("size"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25).alias("quality"),
    )
    more = df.union(spark.createDataFrame([(99_999, "t", 3_000, 1.0)], df.schema))
    got = mixing.mix(more, weights=(1, 3)).where("row.source = 's'")
    n = {r.even: r.n for r in got.groupBy((F.col("row.doc_id") % 2 == 0).alias("even")).agg(F.sum("repeats").alias("n")).collect()}
    goal = got.first().target
    assert n[True] + n[False] == pytest.approx(goal, abs=1)
    # With cut x: 1 - exp(-x) of the better and 1 - exp(-x / 4) of the others.
    x = next(k / 1000 for k in range(1, 9000) if 10_000 * (2 - math.exp(-k / 1000) - math.exp(-k / 4000)) >= goal)
    assert n[True] == pytest.approx(10_000 * (1 - math.exp(-x)), rel=0.03)


def test_rows_of_one_id_are_not_sorted_in_one_task(spark, tmp_dir):
    """Rows without an id: mixed as defined, and spread over tasks."""
    rows = [(None if k % 2 else k, "w " * (1 + k % 37), "ab"[k % 3 == 0]) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert query(spark, write_tables(spark, tmp_dir, docs)) == mixed(rows)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        alike = spark.range(8000).select(
            F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(5).cast("long").alias("size"),
            F.lit(1.0).alias("quality"),
        )
        tasks = mixing.mix(alike).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in tasks) < 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_table_and_clashing_columns(spark, tmp_dir):
    assert query(spark, write_tables(spark, tmp_dir, no_documents(spark))) == []
    docs = edge_documents(spark, extra=True).drop("size", "quality")
    docs = docs.withColumns({"size": mixing.n_words(F.col("text")), "quality": F.lit(1.0)})
    got = mixing.mix(docs).select("row.*")
    assert got.columns == docs.columns and got.count() == len(edge_rows())
