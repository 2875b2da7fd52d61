"""Exact leaderboard across micro-batches (R6 table from changelog, R7 bounded
board with eviction, R8/S15 deltas as JSON), in ``foreachBatch``.

The counts of all live names are keyed state of the stream
(:func:`tallyho.streaming.trailing.board_stream`), spread over buckets of names, and
a batch brings the highest counts of the buckets where those changed. So what is
written per batch follows the names that changed; here at most ``size`` rows of each
bucket are held, whatever the number of names.

For batch b: the buckets' rows replace those of the same buckets in the table of
tops as of batch b-1, and the board is the top ``size`` of the table. A name off the
board keeps its count in the state, so it comes back when others fall. Deltas are
the difference of two boards: names that entered or whose count changed, and names
that left, with count 0.

The table and the board are written to one of ``SLOTS`` folders in turn, with
overwrite, so they don't pile up, and a batch that is repeated reads the table
of the batch before it and gives the same result. Deltas and messages, the
output to subscribers, are written under ``batch=<id>`` where there are any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.render import counts_json
from ..operators.board import BOARD_SIZE, board, delta_messages

TOP_SCHEMA = "batch long, bucket int, name string, n long"
BOARD_SCHEMA = "batch long, rank int, name string, n long"
DELTA_SCHEMA = "name string, count long"
MESSAGE_SCHEMA = "bucket timestamp, part long, entries long, message string"
SLOTS = 3


def previous_tops(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """(bucket, name, n): the highest counts of all buckets after the newest of the last
    batches (none before the first)."""
    for before in range(1, SLOTS):
        try:
            rows = spark.read.schema(TOP_SCHEMA).parquet(f"{out}/tops/slot={(batch_id - before) % SLOTS}")
        except AnalysisException:  # no such slot yet
            continue
        rows = rows.where(F.col("batch") == batch_id - before)
        if not rows.isEmpty():  # each batch writes a row without a bucket
            return rows.where(F.col("bucket").isNotNull()).select("bucket", "name", "n")
    return spark.createDataFrame([], "bucket int, name string, n long")


def step_tops(prev: DataFrame, changed: DataFrame) -> DataFrame:
    """(bucket, name, n) after a batch: the changed buckets' rows, and the other
    buckets' as they were."""
    return prev.join(changed.select("bucket").distinct(), "bucket", "left_anti").select("bucket", "name", "n").union(
        changed.select("bucket", "name", "n")
    )


def board_deltas(prev: DataFrame, now: DataFrame) -> DataFrame:
    """(name, count) from two boards: names that entered or changed, and
    names that left, with count 0."""
    both = prev.select("name", F.col("n").alias("n_old")).join(
        now.select("name", F.col("n").alias("n_new")), "name", "full_outer"
    )
    return both.where(~F.col("n_old").eqNullSafe(F.col("n_new"))).select(
        "name", F.coalesce("n_new", F.lit(0)).alias("count")
    )


def board_sink(size: int = BOARD_SIZE) -> Callable[[str], Callable[[DataFrame, int], None]]:
    """foreachBatch sink factory for :func:`tallyho.streaming.runner.replay_runs`.

    The batch is read once, and held in a folder beside the tables; boards and
    deltas come from the tables as written.
    """

    def make(out: str) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            spark, slot = batch.sparkSession, batch_id % SLOTS
            held = f"{out}/changed/slot={slot}"
            batch.select("bucket", "name", "n").write.mode("overwrite").parquet(held)
            changed = spark.read.schema("bucket int, name string, n long").parquet(held)
            prev = previous_tops(spark, out, batch_id)
            number = F.lit(batch_id).cast("long").alias("batch")
            marker = spark.createDataFrame([(batch_id, None, None, 0)], TOP_SCHEMA)
            tops_path = f"{out}/tops/slot={slot}"
            step_tops(prev, changed).select(number, "bucket", "name", "n").union(marker).write.mode("overwrite").parquet(tops_path)
            tops = spark.read.schema(TOP_SCHEMA).parquet(tops_path).where(F.col("name").isNotNull())
            board_path = f"{out}/board/slot={slot}"
            board(tops.select("name", "n"), size).select(number, "rank", "name", "n").write.mode("overwrite").parquet(board_path)
            now = spark.read.schema(BOARD_SCHEMA).parquet(board_path)
            prev = prev.where(F.col("name").isNotNull())
            if changed.isEmpty():
                return
            deltas = board_deltas(board(prev.select("name", "n"), size), now).cache()  # at most 2 * size rows
            try:
                if not deltas.isEmpty():
                    deltas.write.mode("overwrite").parquet(f"{out}/deltas/batch={batch_id}")
                    deltas.agg(
                        F.count(F.lit(1)).alias("entries"),
                        counts_json(F.collect_list(F.struct("name", "count"))).alias("message"),
                    ).write.mode("overwrite").parquet(f"{out}/messages/batch={batch_id}")
            finally:
                deltas.unpersist()

        return write

    return make


def flush_sink(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of :func:`tallyho.streaming.trailing.flush_stream`: the JSON messages
    (bucket, part, entries, message) of the batch's times under ``batch=<id>``. A time's
    rows all come in one batch, so a repeated batch sends the same messages. The
    batch is computed once and held in one of a few folders in turn, beside ``out``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = f"{out}-flush/slot={batch_id % SLOTS}"
        batch.write.mode("overwrite").parquet(held)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(held)
        done = rows.sparkSession.createDataFrame([], MESSAGE_SCHEMA)
        if not rows.isEmpty():
            done = delta_messages(rows).select("bucket", F.col("part").cast("long"), "entries", "message")
        done.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def delta_steps(spark: SparkSession, out: str) -> DataFrame:
    """(step, name, count): all deltas, the batches that had some numbered
    from 1."""
    deltas = spark.read.schema("batch long, " + DELTA_SCHEMA).parquet(f"{out}/deltas")
    batches = sorted(r["batch"] for r in deltas.select("batch").distinct().collect())  # one row per flush
    numbers = spark.createDataFrame([(b, i) for i, b in enumerate(batches, 1)], "batch long, step int")
    return deltas.join(numbers, "batch").select("step", "name", "count")


def boards_from_deltas(deltas: DataFrame) -> DataFrame:
    """(step, rank, name, n): the board that a subscriber who applies the
    deltas has after each step."""
    by_name = Window.partitionBy("name").orderBy("step")
    last = F.max("step").over(Window.partitionBy())  # deltas of boards: bounded by board size and steps
    until = F.coalesce(F.lead("step").over(by_name) - 1, last)
    held = deltas.withColumn("until", until).where(F.col("count") > 0)
    held = held.select(F.explode(F.sequence("step", "until")).alias("step"), "name", F.col("count").alias("n"))
    rank = F.row_number().over(Window.partitionBy("step").orderBy(F.desc("n"), F.asc("name")))
    return held.select("step", rank.alias("rank"), "name", "n")
