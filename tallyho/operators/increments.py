"""Daily counts and top lists that follow the segments as they land, or land again
(A4, W1 with S7).

A segment's counts by day and name are kept. When segments are offered, theirs are counted, and the
counts that they had before, if any, are taken back; the differences go to the days
they lie in, and only those days' counts and top lists are made anew. So a run's work
follows the offered segments and the days they touch, not the feed.

The three tables are versioned (:mod:`tallyho.sources.versions`), with the run's number as
version: a run that failed is repeated under its number and gives the same, and
readers have the lists of the run before until it is done. Numbers ascend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import VersionedTable
from .topnames import DEFAULT_K, rank_top

SEGMENT_COUNTS = "segment string, day date, name string, n long"
DAY_COUNTS = "day date, name string, n long"
TOPS = "day date, rank int, name string, n long"


class DailyCounts:
    """The tables under ``root``: ``segments``, ``days`` and ``tops``."""

    def __init__(self, spark: SparkSession, root: str, k: int = DEFAULT_K):
        self.k, self.root = k, root
        self.segments = VersionedTable(spark, f"{root}/segments", SEGMENT_COUNTS, "segment")
        self.days = VersionedTable(spark, f"{root}/days", DAY_COUNTS, "day")
        self.tops = VersionedTable(spark, f"{root}/tops", TOPS, "day")

    def offer(self, number: int, segments: DataFrame, mentions: DataFrame) -> None:
        """Take whole ``segments`` (segment) with their ``mentions`` (segment, day, name), in
        place of what earlier runs had of them. A segment without mentions becomes empty."""
        spark = mentions.sparkSession
        offered = segments.select("segment").distinct()
        counts = mentions.groupBy("segment", "day", "name").agg(F.count(F.lit(1)).alias("n"))
        earlier = self.segments.newest(number)
        self.segments.change(number, offered, counts.join(offered, "segment", "left_semi"))
        old = self.segments.rows(earlier, offered).withColumn("n", -F.col("n"))
        both = self.segments.rows(number, offered).union(old)
        # Partial sums before the shuffle; a name that half of the rows have is one row a task.
        changes = both.groupBy("day", "name").agg(F.sum("n").alias("n")).where("n <> 0")
        changed = f"{self.root}/changes/run={number}"
        changes.write.mode("overwrite").parquet(changed)
        changes = spark.read.schema(DAY_COUNTS).parquet(changed)
        days = changes.select("day").distinct()
        before = self.days.rows(self.days.newest(number), days)
        now = before.union(changes).groupBy("day", "name").agg(F.sum("n").alias("n")).where("n > 0")
        self.days.change(number, days, now)
        self.tops.change(number, days, rank_top(self.days.rows(number, days), self.k))

    def top(self) -> DataFrame:
        """(day, rank, name, n) as of the newest run."""
        return self.tops.rows(self.tops.newest())
