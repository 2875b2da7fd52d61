"""Trailing count per name over a retention period (batch form, W4/R5).

Each mention adds +1 at its time and -1 at time + retention. The count after
a change is the running sum of those steps per name, ordered by (time,
step, event_id): at equal times the expiry (-1) comes first, so the count
at t covers the half-open period (t - retention, t]. The running sum is
hot-key safe (:func:`tallyho.operators.running.running_sum`).

Output rows (name, event_id, kind, change_ts, n) form the changelog a
stream emits in update mode: one row per arrival and per expiry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import running_sum

RETENTION_MINUTES = 60
ARRIVAL = "arrival"
EXPIRY = "expiry"


def shift_minutes(ts, minutes: int):
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.unix_micros(c) + F.lit(int(minutes) * 60_000_000))


def steps(mentions: DataFrame, retention_minutes: int = RETENTION_MINUTES) -> DataFrame:
    """(name, event_id, kind, change_ts, d): +1 on arrival, -1 on expiry.

    Both steps come from one read of the mentions (a two-element array
    turned into rows), not a union that would scan the input twice.
    """
    both = F.array(
        F.struct(F.lit(ARRIVAL).alias("kind"), F.col("ts").alias("change_ts"), F.lit(1).alias("d")),
        F.struct(
            F.lit(EXPIRY).alias("kind"),
            shift_minutes("ts", retention_minutes).alias("change_ts"),
            F.lit(-1).alias("d"),
        ),
    )
    return mentions.select("name", "event_id", F.inline(both))


def trailing_changelog(
    mentions: DataFrame, retention_minutes: int = RETENTION_MINUTES
) -> DataFrame:
    """(name, event_id, kind, change_ts, n) for every arrival and expiry."""
    s = steps(mentions, retention_minutes)
    out = running_sum(s, ["name"], ["change_ts", "d", "event_id"], F.col("d").cast("bigint"), "n")
    return out.select("name", "event_id", "kind", "change_ts", "n")


def live_counts(mentions: DataFrame, as_of: dt.datetime, retention_minutes: int = RETENTION_MINUTES) -> DataFrame:
    """(name, n): mentions in (as_of - retention, as_of], names without one
    left out. The same as the changelog's last counts at ``as_of``, from the
    last period alone: the bounds are literals, so the scan skips the rest.
    """
    kind = mentions.schema["ts"].dataType
    lo, hi = (
        F.lit(t.isoformat(sep=" ")).cast(kind) for t in (as_of - dt.timedelta(minutes=retention_minutes), as_of)
    )
    return (
        mentions.where((F.col("ts") > lo) & (F.col("ts") <= hi))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def arrival_counts(changelog: DataFrame) -> DataFrame:
    """(name, event_id, ts, n): the count each arrival produced."""
    return changelog.where(F.col("kind") == ARRIVAL).select(
        "name", "event_id", F.col("change_ts").alias("ts"), "n"
    )
