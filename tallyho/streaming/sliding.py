"""Declarative trailing counts (R4): mentions per name in sliding event-time
windows, with a watermark bounding the state.

On the stream, mentions are counted per name and slot, the slot being as long
as the slide: one state row per name and slot, whatever the window's length.
A sliding window is the sum of its ``window / slide`` slots; that sum is made
from the slots' counts (a few rows per name), not from the mentions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slot_counts(mentions: DataFrame, slot: str = "5 minutes", watermark: str = "1 hour") -> DataFrame:
    """(slot_start, name, n) on a stream; use output mode ``update``."""
    return (
        mentions.withWatermark("ts", watermark)
        .groupBy(F.window("ts", slot).alias("w"), "name")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("slot_start"), "name", "n")
    )


def final_counts(updates: DataFrame) -> DataFrame:
    """Collapse update-mode output (several rows per slot and name as it
    grows) to the final count: counts only grow, so the largest wins. Rows are dealt by
    name (a few for each of its slots), so the windows' sums need no further shuffle."""
    return updates.repartition("name").groupBy("slot_start", "name").agg(F.max("n").alias("n"))


def window_counts(slots: DataFrame, window_minutes: int, slot_minutes: int) -> DataFrame:
    """(window_start, window_end, name, n) of every sliding window with a
    mention, from final slot counts."""
    if window_minutes % slot_minutes:
        raise ValueError("the window must be a whole number of slots")
    starts = F.sequence(
        F.col("slot_start") - F.expr(f"INTERVAL {window_minutes - slot_minutes} MINUTES"),
        F.col("slot_start"),
        F.expr(f"INTERVAL {slot_minutes} MINUTES"),
    )
    return (
        slots.select(F.explode(starts).alias("window_start"), "name", "n")
        .groupBy("window_start", "name")
        .agg(F.sum("n").alias("n"))
        .select(
            "window_start",
            (F.col("window_start") + F.expr(f"INTERVAL {window_minutes} MINUTES")).alias("window_end"),
            "name",
            "n",
        )
    )
