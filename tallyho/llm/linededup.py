"""Operator 3, line dedup by site-relative frequency, in DataFrame functions.

For each host, the share of its pages that hold a line; lines above a share
are boilerplate of that host and are dropped from its pages. Pages with equal
text count as one page, in the line's count and in the host's, so a page that
was copied often is not taken for boilerplate. Copies of a line within a page
count once.

Lines are compared by 64-bit hashes, exactly as they stand between newlines.
Counting shuffles (host, line, page) hashes, combined before the shuffle. A
host has fewer boilerplate lines than its mean lines per page over the ratio,
so they are held as one short array per host and joined to the documents;
Spark broadcasts that table while it is small and else splits hot hosts.

Defined results: lines without a word are never counted or dropped. A null text
stays null; an empty one stays empty. A page whose lines all go keeps its row with
an empty text. A null host is a host of its own. Repeated rows are one page. An
empty table gives an empty result. The input's columns come back in one struct,
``row``. Texts of any length are cut into all their lines; one text and its lines
must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written
from .words import with_row

#: A line on more than this share of its host's pages is boilerplate ...
MAX_RATIO = 0.1
#: ... if it is on at least so many pages.
MIN_PAGES = 5
HAS_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(host, lines): hashes of each host's boilerplate lines."""
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("page"))
    worded = F.transform(F.filter(_lines(F.col("t")), lambda x: x.rlike(HAS_WORD)), lambda x: F.xxhash64(x))
    counts = (
        pages.select("host", "page", F.explode(F.array_distinct(worded)).alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    totals = (
        pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    ).withColumnRenamed("host", "h")
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("h")))
        .where(F.col("n") > max_ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` as struct ``row`` with (n_lines, n_dropped, clean_text)."""
    bad = written(boilerplate(docs, host, text, max_ratio, min_pages), "boilerplate")
    whole = F.col(f"row.{text}")
    kept = F.filter(_lines(whole), lambda x: ~F.array_contains(F.col("lines"), F.xxhash64(x)))
    joined = with_row(docs).join(bad, F.col(f"row.{host}").eqNullSafe(F.col("host")), "left")
    return joined.withColumn("kept", F.when(F.col("lines").isNotNull(), kept)).select(
        "row",
        F.coalesce(F.size(_lines(whole)).cast("long") * whole.isNotNull().cast("long"), F.lit(0)).alias("n_lines"),
        F.when(F.col("kept").isNotNull(), F.size(_lines(whole)) - F.size("kept")).otherwise(0).cast("long").alias("n_dropped"),
        F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(whole).alias("clean_text"),
    )
