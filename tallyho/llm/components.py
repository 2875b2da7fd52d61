"""Connected components of a large edge list, by alternating star rounds.

Each round replaces edges by edges to the smallest neighbour, first from
larger neighbours of every node, then from smaller ones. All work is grouped
minima (combined before the shuffle) and joins that Spark can split where one
node has very many edges. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # edges run from the larger node a to the smaller b
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is
    its smallest node. Self loops and repeats don't matter; a node with no
    edge to another is not listed."""
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = _mark(now)
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
