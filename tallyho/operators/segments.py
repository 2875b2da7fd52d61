"""15-minute segment bookkeeping: expected names, missing ones, new ones,
and the last published record key.

The segment list is one row per 15 minutes of covered time, so it is
metadata-sized (35,040 rows per year) whatever the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import DEFAULT_LAST_KEY, parse_record_key
from ..functions.times import SLOT_MINUTES, segment_name, slot_start

# The newest segment assumed seen before the first run, and
# the default look-back window of a poll.
DEFAULT_MARK = "20150218230000.gkg.csv"
WINDOW_MINUTES = 60


def landed_segments(records: DataFrame, ts_col: str = "ts", minutes: int = SLOT_MINUTES) -> DataFrame:
    """(file_name): distinct segment names of the rows' slots."""
    return records.select(segment_name(slot_start(ts_col, minutes)).alias("file_name")).distinct()


def landed_files(records: DataFrame) -> DataFrame:
    """(file_name): distinct input file names of a scanned folder."""
    return records.select(F.col("_metadata.file_name").alias("file_name")).distinct()


def expected_segments(landed: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """(file_name): every slot from the first landed segment to the last."""
    slots = landed.select(
        F.try_to_timestamp(F.substring("file_name", 1, 12), F.lit("yyyyMMddHHmm")).alias("slot")
    )
    bounds = slots.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    step = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    slots_all = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", step)).alias("slot")
    )
    return slots_all.select(segment_name("slot").alias("file_name"))


def poll_window(now: Column | str, window_minutes: int = WINDOW_MINUTES, minutes: int = SLOT_MINUTES) -> Column:
    """Names a poll at ``now`` expects: the last complete slot (floor(now)
    minus one slot) and the slots before it inside ``window_minutes``."""
    now_c = F.col(now) if isinstance(now, str) else now
    last = slot_start(now_c, minutes) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    first = last - F.expr(f"INTERVAL {int(window_minutes - minutes)} MINUTES")
    step = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return F.transform(F.sequence(first, last, step), lambda s: segment_name(s))


def missing_segments(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected names that have not landed (anti join on the name)."""
    return expected.join(landed, "file_name", "left_anti")


def new_segments(landed: DataFrame, last_mark: str | Column = DEFAULT_MARK) -> DataFrame:
    """(file_name, next_mark): landed names newer than the high-water mark,
    and the mark after offering them (the newest whole name seen, so that the
    next poll doesn't offer that file again).

    The mark is a window over the new names only (one row per 15-minute
    segment, so their number is set by the calendar), computed in the same
    pass as the names.
    """
    newer = landed.where(F.col("file_name") > (F.lit(last_mark) if isinstance(last_mark, str) else last_mark))
    everything = Window.partitionBy()
    return newer.select("file_name", F.max("file_name").over(everything).alias("next_mark"))


def record_key_parts(keys: DataFrame, key_col: str = "record_key") -> DataFrame:
    """Adds key_ts and key_seq parsed from ``ts-seq`` ((0, 0) if malformed)."""
    parsed = parse_record_key(key_col)
    return keys.withColumn("key_ts", parsed["key_ts"]).withColumn("key_seq", parsed["key_seq"])


def last_record_key(keys: DataFrame, key_col: str = "record_key", default: str = DEFAULT_LAST_KEY) -> DataFrame:
    """One row: the greatest key by (ts, seq), or ``default`` when empty."""
    parsed = parse_record_key(key_col)
    top = keys.agg(F.max(F.struct(parsed["key_ts"].alias("a"), parsed["key_seq"].alias("b"))).alias("m"))
    return top.select(
        F.coalesce(
            F.concat(F.col("m.a").cast("string"), F.lit("-"), F.col("m.b").cast("string")),
            F.lit(default),
        ).alias("last_key")
    )
