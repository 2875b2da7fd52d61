"""Leaderboard of the most mentioned names right now, and its deltas.

* :func:`latest_per_name` (A11/R6): last count per name as of a time; names
  whose count is 0 are not live and left out.
* :func:`board` (T4): exact top ``size`` by count desc, name asc.
* :func:`board_floor` (A9/A10): entries, lowest count and its name.
* :func:`coalesce_deltas` (R8) and :func:`delta_messages` (S15/S16): one
  value per (bucket, name), rendered as a JSON array per bucket.

The top-k is ``orderBy().limit()``, planned as a per-task top-k followed by
a merge of at most ``size`` rows per task, so no task sees all names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.render import counts_json
from .running import row_index
from .trailing import EXPIRY

BOARD_SIZE = 100
# names per delta message part (bounds one group's list)
MESSAGE_ENTRIES = 10_000


def _change_order() -> Column:
    # expiry before arrival at equal times, then event id: the changelog order
    return F.struct(
        F.col("change_ts"),
        F.when(F.col("kind") == EXPIRY, F.lit(0)).otherwise(F.lit(1)),
        F.col("event_id"),
    )


def last_counts(changelog: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(name, n): each name's count after its last change at or before
    ``as_of`` (all changes when None), 0 where nothing is left."""
    rows = changelog if as_of is None else changelog.where(F.col("change_ts") <= as_of)
    return rows.groupBy("name").agg(F.max_by(F.col("n"), _change_order()).alias("n"))


def latest_per_name(changelog: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(name, n): the live names of :func:`last_counts`."""
    return last_counts(changelog, as_of).where(F.col("n") > 0)


def board(latest: DataFrame, size: int = BOARD_SIZE) -> DataFrame:
    """(rank, name, n): exact top ``size`` names by count, ties by name."""
    top = latest.orderBy(F.desc("n"), F.asc("name")).limit(size)
    # ranks over at most `size` rows (already cut by the limit)
    w = Window.orderBy(F.desc("n"), F.asc("name"))
    return top.select(F.row_number().over(w).alias("rank"), "name", "n")


def board_floor(board_df: DataFrame) -> DataFrame:
    """One row: entries on the board, lowest count, and the first name (by
    name) holding it - the entry a new name would replace."""
    return board_df.agg(
        F.count(F.lit(1)).alias("entries"),
        F.min("n").alias("floor_n"),
        F.min_by(F.col("name"), F.struct(F.col("n"), F.col("name"))).alias("floor_name"),
    )


def coalesce_deltas(changelog: DataFrame, every_seconds: int = 1) -> DataFrame:
    """(bucket, name, count): the last value per name within each bucket of
    ``every_seconds`` (pending changes coalesced, as between two flushes)."""
    micros = F.unix_micros("change_ts")
    width = F.lit(int(every_seconds) * 1_000_000)
    bucket = F.timestamp_micros(micros - F.pmod(micros, width))
    return (
        changelog.withColumn("bucket", bucket)
        .groupBy("bucket", "name")
        .agg(F.max_by(F.col("n"), _change_order()).alias("count"))
    )


def delta_messages(deltas: DataFrame, max_entries: int = MESSAGE_ENTRIES) -> DataFrame:
    """(bucket, part, entries, message): the bucket's changes as JSON arrays
    ``[{"name":...,"count":...},...]``, name-sorted and cut into parts of at
    most ``max_entries`` names (part 0 holds the first names, and so on).

    A bucket can hold any number of changed names, so no group collects a
    whole bucket: names are numbered per bucket (hot-bucket safe, see
    :func:`tallyho.operators.running.row_index`) and each part is one group.
    """
    numbered = row_index(deltas, ["bucket"], ["name"], "_i")
    parts = numbered.withColumn("part", F.expr(f"(_i - 1) div {int(max_entries)}"))
    return parts.groupBy("bucket", "part").agg(
        F.count(F.lit(1)).alias("entries"),
        counts_json(F.collect_list(F.struct(F.col("name"), F.col("count")))).alias("message"),
    )


def snapshot_message(latest: DataFrame) -> DataFrame:
    """One row: the whole board as one JSON message (sent on connect).
    Use on a board (bounded), not on the full latest table."""
    return latest.agg(
        counts_json(F.collect_list(F.struct(F.col("name"), F.col("n").alias("count")))).alias("message")
    )
