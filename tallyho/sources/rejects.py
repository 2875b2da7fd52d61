"""Lines of the feed that can't be used, apart from the others and by reason, in the
pass that reads them (F5, S18, R9).

A line may have several reasons: it is ``short`` (fewer than 24 fields), has ``no_stamp`` (a
record id without a time, so the feeder can't publish it), is ``undated`` (not short,
and its date doesn't parse, so it belongs to no day), or has ``bad_bytes`` (malformed UTF-8,
which is left out of its fields; that alone doesn't reject it).

One scan serves both outputs and the counts: the lines are written once, in a folder for
each channel, and counts by reason are observed on their way (``DataFrame.observe``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import first_field
from ..functions.times import day_of_stamp, stamp_instant
from .feed import DATE_INDEX, MIN_FIELDS, _field, _n_fields

REASONS = ("short", "no_stamp", "undated", "bad_bytes")
KEPT_WITH = ("bad_bytes",)
SCHEMA = "value string, reasons array<string>, channel string"
LINES, REJECTS = "lines", "rejects"


def with_reasons(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """(value, reasons, channel) of raw lines."""
    short = _n_fields(line_col) < MIN_FIELDS
    found = {
        "short": short,
        "no_stamp": stamp_instant(first_field(first_field(line_col), "-")).isNull(),
        "undated": ~short & day_of_stamp(_field(line_col, DATE_INDEX)).isNull(),
        "bad_bytes": ~F.is_valid_utf8(F.col(line_col)),
    }
    reasons = F.array_compact(F.array(*(F.when(found[r], r) for r in REASONS)))
    usable = F.size(F.array_except(F.col("reasons"), F.array(*map(F.lit, KEPT_WITH)))) == 0
    return lines.select(F.col(line_col).alias("value"), reasons.alias("reasons")).withColumn(
        "channel", F.when(usable, LINES).otherwise(REJECTS)
    )


def split_lines(lines: DataFrame, out: str, line_col: str = "value") -> dict[str, int]:
    """Write the lines to ``out``, a folder for each channel, and return the counts of all
    lines, of the rejected ones, and of each reason."""
    seen = Observation("lines")
    counts = [F.count_if(F.array_contains("reasons", r)).alias(r) for r in REASONS]
    checked = with_reasons(lines, line_col).observe(
        seen, F.count(F.lit(1)).alias(LINES), F.count_if(F.col("channel") == REJECTS).alias(REJECTS), *counts
    )
    checked.write.mode("errorifexists").partitionBy("channel").parquet(out)
    return dict(seen.get)


def read_channel(spark: SparkSession, out: str, channel: str) -> DataFrame:
    """(value, reasons) of one channel."""
    return spark.read.schema(SCHEMA).parquet(out).where(F.col("channel") == channel).select("value", "reasons")
