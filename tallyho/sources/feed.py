"""Readers for the tab-separated article feed (batch and stream share them).

* :func:`read_typed` - typed scan with the fixed 27-column schema (S1, S3).
* :func:`read_lines` - raw-line scan, positional access (S2, S3, S18).
* :func:`as_feed` - typed view of feed rows from another source (F7).
* :func:`articles_from_typed` / :func:`articles_from_lines` - the one parse
  step both batch and streaming queries use: (record_id, day, AllNames).
* :func:`record_mentions` - published records (key, value, timestamp) ->
  one row per mentioned name, for streams (R1).

Quoting is off (``quote=''``): a leading ``"`` in a field is data, not the
start of a quoted field that would swallow tabs. Malformed UTF-8 is decoded
leniently and the replacement characters are removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import NOISE_NAMES, drop_malformed, is_name, name_tokens, strip_offset
from ..functions.times import day_of_stamp
from ..schema import ALL_NAMES_INDEX, DATE_INDEX, FEED_SCHEMA, MIN_FIELDS, RECORD_ID_INDEX

FIELD_SEP = "\t"


def _reader(spark: SparkSession, glob_filter: str | None, recursive: bool):
    reader = spark.read
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader


def read_typed(
    spark: SparkSession,
    path: str | list[str],
    glob_filter: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Typed scan of feed files (any Hadoop path or glob, e.g. ``s3a://``)."""
    return (
        _reader(spark, glob_filter, recursive)
        .schema(FEED_SCHEMA)
        .option("sep", FIELD_SEP)
        .option("quote", "")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    glob_filter: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Raw lines of feed files: one ``value`` string per line."""
    return _reader(spark, glob_filter, recursive).text(path)


def as_feed(rows: DataFrame) -> DataFrame:
    """Typed view of feed rows from any source (F7): columns matched by name
    and put in the fixed order (``DataFrame.to``). Types are only widened
    where that is safe; a missing column, or text where a number is
    expected, is an error rather than a silent cast."""
    return rows.to(FEED_SCHEMA)


def articles_from_typed(feed: DataFrame) -> DataFrame:
    """Typed feed rows -> (record_id, day, AllNames). Only 3 of 27 columns
    are referenced, so the scan reads only those (column pruning)."""
    return feed.select(
        F.col("GKGRECORDID").alias("record_id"),
        day_of_stamp("DATE").alias("day"),
        drop_malformed("AllNames").alias("AllNames"),
    )


def _n_fields(line_col: str):
    """Fields of a raw line, counted without cutting it."""
    return F.length(line_col) - F.length(F.translate(line_col, FIELD_SEP, "")) + 1


def _field(line_col: str, index: int):
    """One cleaned field of a raw line, found by its tabs: cheap enough to be
    evaluated again in a filter, and the other fields are never made."""
    up_to = F.substring_index(F.col(line_col), FIELD_SEP, index + 1)
    return drop_malformed(F.substring_index(up_to, FIELD_SEP, -1))


def articles_from_lines(lines: DataFrame, line_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Raw lines -> (*keep, record_id, day, AllNames); rows with fewer than
    24 fields are dropped (see :func:`line_report` for their count)."""
    return lines.where(_n_fields(line_col) >= MIN_FIELDS).select(
        *keep,
        _field(line_col, RECORD_ID_INDEX).alias("record_id"),
        day_of_stamp(_field(line_col, DATE_INDEX)).alias("day"),
        _field(line_col, ALL_NAMES_INDEX).alias("AllNames"),
    )


def line_report(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row: lines read, short lines dropped, lines with no date, lines
    with an empty name list. A single global aggregate (partial per task)."""
    rows = lines.select(
        (_n_fields(line_col) < MIN_FIELDS).alias("_short"),
        day_of_stamp(_field(line_col, DATE_INDEX)).isNull().alias("_undated"),
        (F.coalesce(_field(line_col, ALL_NAMES_INDEX), F.lit("")) == "").alias("_empty"),
    )
    return rows.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("_short").alias("short_lines"),
        F.count_if(~F.col("_short") & F.col("_undated")).alias("undated_lines"),
        F.count_if(~F.col("_short") & F.col("_empty")).alias("empty_name_lines"),
    )


def mention_id(key_col: str = "record_key", position_col: str = "position"):
    """What identifies a mention: ``xxhash64(record key, position in the list)``."""
    return F.xxhash64(key_col, position_col).alias("event_id")


def record_mentions(
    records: DataFrame,
    strip: str = "last",
    noise: Iterable[str] = NOISE_NAMES,
) -> DataFrame:
    """Published records (key, value = feed line, timestamp) -> (event_id,
    record_key, name, ts): one row per mentioned name, at the record's event
    time. Stateless, so it runs unchanged on a stream (R1) or a batch.
    """
    return record_positions(records, strip, noise).select(mention_id(), "record_key", "name", "ts")


def record_positions(
    records: DataFrame,
    strip: str = "last",
    noise: Iterable[str] = NOISE_NAMES,
) -> DataFrame:
    """:func:`record_mentions` with the name's position in the list in place of the id that
    follows from it: (record_key, position, name, ts), the form to store, as ids hardly
    compress."""
    arts = articles_from_lines(records, keep=["key", "timestamp"])
    # Cut inside the list: a filter on the exploded names would cut each of them again.
    names = F.transform(name_tokens("AllNames"), lambda t: strip_offset(t, strip))
    named = arts.where(F.col("AllNames") != F.lit("")).select(
        F.col("key").alias("record_key"), F.posexplode(names).alias("position", "name"), F.col("timestamp").alias("ts")
    )
    return named.where(is_name("name", noise))
