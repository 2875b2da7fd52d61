"""Table of the latest count of each name, written as changes and read as a whole (R6, A11).

A batch appends the names that changed, a count of 0 for those that are gone. Readers merge
the base and the batches since it: of each name the newest version counts. Compaction
writes that merge as the new base; batches and readers go on meanwhile, since it lists its base
in place of the versions that it read, and what landed since stays listed.

The files are a :class:`tallyho.sources.versions.VersionedTable` whose parts are the versions
themselves. Versions ascend over batches and compactions, which one writer numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import VersionedTable

SCHEMA = "step long, name string, n long"


class LatestCounts:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, SCHEMA, "step")

    def upsert(self, version: int, counts: DataFrame) -> None:
        """Take (name, n) as the latest of these names."""
        step = F.lit(version).cast("long").alias("step")
        self.table.change(version, self._steps(version), counts.select(step, "name", "n"))

    def read(self, version: int | None = None) -> DataFrame:
        """(name, n): the live names as of a version (default: the newest)."""
        return self._merged(version).where("n > 0").select("name", "n")

    def _merged(self, version: int | None) -> DataFrame:
        rows = self.table.rows(self.table.newest() if version is None else version)
        return rows.groupBy("name").agg(F.max_by("n", "step").alias("n"))

    def compact(self, version: int, upto: int) -> None:
        """Write the merge as of ``upto`` as one base, under ``version``. Batches numbered
        between the two stay and count over the base."""
        read = self.table.live(upto).select("step")
        # The base stands where the newest batch in it stood.
        base = self._merged(upto).where("n > 0").select(F.lit(upto).cast("long").alias("step"), "name", "n")
        self.table.change(version, self._steps(upto), base, gone=read)

    def _steps(self, step: int) -> DataFrame:
        return self.spark.createDataFrame([(step,)], "step long")
