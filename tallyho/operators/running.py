"""Running sums and row numbers per key, for keys of any size.

A plain ``sum(v) OVER (PARTITION BY key ORDER BY ...)`` sends every row of a
key to one task. Here one plan serves all sizes and any number of hot keys:

1. the rows are range-partitioned by (key, order), so a hot key lies in
   several neighbouring pieces, and written to the shared folder with the
   number of their piece. From then on a row's piece is data: every part of
   the plan, and every recomputed task, sees the same pieces;
2. a running sum within (piece, key), each group being no larger than a piece;
3. the sum of a key's earlier pieces is added. A piece holds at most one key
   that began in an earlier piece, so there are fewer such offsets than
   pieces, whatever the number of keys.

The input is read twice (Spark samples it for the range bounds, then shuffles
it). Nothing reaches the driver, and no broadcast is asked for: the offsets
are joined as Spark sees fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality of column pairs, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def in_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str | None = None, place: str | None = None
) -> DataFrame:
    """``df`` range-partitioned by (keys, order) with the number of each row's
    piece as ``_piece``, written (over what is in ``path``, if that is given) and
    read back. ``place`` names a column with the row's place in the order of its piece,
    from 0: for wide rows, that need not be shuffled again to be counted."""
    path = path or scratch_path(df.sparkSession, "pieces")
    pieced = df.repartitionByRange(*keys, *order)
    if place:
        in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        pieced = pieced.sortWithinPartitions(*keys, *order).withColumn(place, in_partition)
    pieced = pieced.withColumn("_piece", F.spark_partition_id())
    pieced.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(pieced.schema).parquet(path)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str | Column,
    out: str,
    totals: dict[str, Column] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``keys`` in ``order``.

    ``order`` must be a total order within a key (ties make a running sum
    ambiguous); include a unique column last. ``totals`` (name -> aggregate)
    adds whole-key aggregates to every row. Runs one job at build time, which
    writes the pieces (to a new folder, or over ``path``).
    """
    keys = list(keys)
    order_names = [f"_o{i}" for i in range(len(order))]
    shaped = df.withColumns(
        {**dict(zip(order_names, _cols(order), strict=True)), "_v": F.col(value) if isinstance(value, str) else value}
    )
    rows = in_pieces(shaped, keys, order_names, path)
    within = Window.partitionBy("_piece", *keys).orderBy(*order_names).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_piece", *keys)
        .agg(F.sum("_v").alias("_sum"))
        .withColumn("_offset", F.sum("_sum").over(earlier))
        .where(F.col("_offset").isNotNull())  # a key's first piece needs none
        .select(F.col("_piece").alias("_at"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_offset")
    )
    pairs = [(k, f"_k{i}") for i, k in enumerate(keys)]
    summed = (
        rows.withColumn("_local", F.sum("_v").over(within))
        .join(offsets, _same([("_piece", "_at"), *pairs]), "left")
        .withColumn(out, F.col("_local") + F.coalesce("_offset", F.lit(0)))
    )
    if totals:
        whole = rows.groupBy(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys))).agg(
            *[agg.alias(name) for name, agg in totals.items()]
        )
        summed = summed.join(whole, _same([(k, f"_t{i}") for i, k in enumerate(keys)]))
    return summed.select(*df.columns, out, *(totals or {}))


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str = "row_index",
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """1-based position of each row within its key in ``order``; a running
    count."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, totals)
