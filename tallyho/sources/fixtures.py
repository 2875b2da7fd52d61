"""Feeds derived from the driver's tables (the only inputs there are).

* ``documents`` -> article feed: one article per document, the words of the
  text as its name list (``word,i;word,i;...``, i = 1-based word position),
  dated ``2015-02-18 + doc_id % 10`` days. Whole texts are used.
* ``events`` -> mentions: ``name = 'user_' || user_id`` at ``ts``.

Edge rows are made from the ids by fixed rules: noise and comma names, dates
that don't parse, short lines, bad UTF-8 and malformed record ids.

Both are narrow projections (no shuffle); every query built on them grows
with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import record_key
from ..functions.times import as_instant
from ..schema import FEED_COLUMNS

# Fixed values of the derivation (see FIXTURES.md).
FIRST_DAY = "2015-02-18"
DAYS = 10
WORD_SPLIT = "[ \n]+"
NAME_PREFIX = "user_"
EDGE_NAMES = ";null,1;Type ParentCategory,2;Smith, John,3;Broken,4"  # of doc_id % 7 = 3
BAD_DATE = "abc"  # of doc_id % 11 = 5
SHORT_FIELDS = 2  # of doc_id % 17 = 8
UNSTAMPED = "bad"  # record ids of doc_id % 13 = 6; doc_id % 13 = 7 have a dash at the end


def _is(modulus: int, rest: int, column: str = "doc_id"):
    return F.pmod(F.col(column), F.lit(modulus)) == rest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_of_doc(doc_id: str = "doc_id"):
    return F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.col(doc_id), F.lit(DAYS)).cast("int"))


def _name_list(text: str = "text"):
    words = F.filter(F.split(F.col(text), WORD_SPLIT, -1), lambda w: w != F.lit(""))
    tokens = F.transform(
        words, lambda w, i: F.concat(w, F.lit(","), (i + F.lit(1)).cast("string"))
    )
    return F.array_join(tokens, ";")


def articles(documents: DataFrame, *keep: str) -> DataFrame:
    """documents -> (record_id, day, AllNames, short), and the columns to ``keep``."""
    day = _day_of_doc()
    stamp = F.when(_is(13, 6), F.lit(UNSTAMPED)).otherwise(F.date_format(day, "yyyyMMdd000000"))
    end = F.when(_is(13, 7), F.lit("-")).otherwise(F.lit(""))
    names = F.concat(_name_list(), F.when(_is(7, 3), F.lit(EDGE_NAMES)).otherwise(F.lit("")))
    return documents.select(
        F.concat(stamp, F.lit("-"), F.col("doc_id").cast("string"), end).alias("record_id"),
        F.when(~_is(11, 5), day).alias("day"),
        F.when(~_is(17, 8), names).alias("AllNames"),
        _is(17, 8).alias("short"),
        *keep,
    )


def feed_rows(documents: DataFrame) -> DataFrame:
    """documents -> full 27-column feed rows (strings; unused columns null)
    and whether the row is landed short."""
    a = articles(documents)
    cols = {
        "GKGRECORDID": F.col("record_id"),
        "DATE": F.coalesce(F.concat(F.date_format("day", "yyyyMMdd"), F.lit("000000")), F.lit(BAD_DATE)),
        # as landed, one name has a byte that isn't UTF-8
        "AllNames": F.replace("AllNames", F.lit(";Broken,"), F.lit(b";Br\xffoken,").cast("string")),
    }
    return a.select(
        *[cols.get(c, F.lit(None).cast("string")).alias(c) for c in FEED_COLUMNS], "short"
    )


def feed_lines(documents: DataFrame) -> DataFrame:
    """documents -> tab-separated feed lines (``value``), nulls as empty;
    short lines end after their first fields."""
    fields = [F.coalesce(F.col(c), F.lit("")) for c in FEED_COLUMNS]
    whole, cut = F.concat_ws("\t", *fields), F.concat_ws("\t", *fields[:SHORT_FIELDS])
    return feed_rows(documents).select(F.when(F.col("short"), cut).otherwise(whole).alias("value"))


def write_feed_files(documents: DataFrame, path: str, compression: str = "none") -> str:
    """Land the derived feed as text files, one folder per day (like daily
    segment folders). Returns the path written."""
    lines = feed_lines(documents).withColumn(
        "day", F.substring(F.col("value"), F.length(F.substring_index("value", "\t", 1)) + 2, 8)
    )
    lines.write.mode("errorifexists").partitionBy("day").text(path, compression=compression)
    return path


def name_of(user_id: str):
    return F.concat(F.lit(NAME_PREFIX), F.col(user_id).cast("string"))


def mentions(events: DataFrame) -> DataFrame:
    """events -> (event_id, name, ts) with ts as a UTC instant."""
    return events.select(
        F.col("event_id"),
        name_of("user_id").alias("name"),
        as_instant("ts").alias("ts"),
    )


def keyed_lines(events: DataFrame) -> DataFrame:
    """events -> feed-like records: key ``yyyyMMddHHmmss-event_id`` and ts."""
    return events.select(
        F.col("event_id"),
        record_key(as_instant("ts"), "event_id").alias("record_key"),
        as_instant("ts").alias("ts"),
    )


def edge_keys(events: DataFrame) -> DataFrame:
    """:func:`keyed_lines` with malformed keys among them: ``x-1`` for event_id %
    23 = 5, a dash at the end for 6, three parts for 7, no number for 8."""
    key = F.col("record_key")
    return keyed_lines(events).withColumn(
        "record_key",
        F.when(_is(23, 5, "event_id"), F.lit("x-1"))
        .when(_is(23, 6, "event_id"), F.concat(key, F.lit("-")))
        .when(_is(23, 7, "event_id"), F.concat(key, F.lit("-1")))
        .when(_is(23, 8, "event_id"), F.lit("5-"))
        .otherwise(key),
    )
