"""Tables that change by versions of their parts: a list of (part, version) rows says which
rows count.

A change writes the rows of the parts that it touches to ``data/version=<v>``, and then the
whole list as of it to ``live/of=<v>``, in one file. With that file the change counts, so a
reader sees it whole or not at all, and goes on with the rows of its own list while others
change the table. Parts that a change doesn't touch aren't written again. A change that is
repeated under its version overwrites what it left, from the list before it.

The list has a row for each part (a day, a 15-minute segment) and one that names no part; Spark
reads and joins it, only the newest version's number reaches the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionedTable:
    """Rows of ``schema`` under ``path``; ``part`` is the column that names their part."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.empty = spark.createDataFrame([], schema)
        self.schema = self.empty.schema

    def newest(self, before: int | None = None) -> int | None:
        """The newest version, or the newest below ``before``."""
        lists = self._read("live", "of long")
        if lists is None:
            return None
        return lists.where(F.lit(True) if before is None else F.col("of") < before).agg(F.max("of")).first()[0]

    def live(self, version: int | None) -> DataFrame:
        """(part, version): the version that holds each part's rows, as of a version."""
        kind = self.schema[self.part].dataType.simpleString()
        schema = f"`{self.part}` {kind}, version long"
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/live/of={version}").where("version >= 0")

    def rows(self, version: int | None, parts: DataFrame | None = None) -> DataFrame:
        """The table as of a version; only of some ``parts`` (one column, distinct). Folders
        of versions that the list doesn't name are pruned when the query runs."""
        live = self.live(version)
        if parts is not None:
            live = live.join(parts, self.part, "left_semi")
        data = self._read("data", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema) + ", version long")
        if version is None or data is None:
            return self.empty
        return data.join(live, [self.part, "version"], "left_semi").select(*self.schema.names)

    def change(self, version: int, touched: DataFrame, rows: DataFrame, gone: DataFrame | None = None) -> None:
        """Put ``rows`` in the place of those of the parts ``touched`` (one column, distinct);
        a part without rows is empty then. Parts that are ``gone`` leave the list."""
        before = self.live(self.newest(version))
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/data/version={version}")
        now = touched.where(F.col(self.part).isNotNull()).select(self.part, F.lit(version).cast("long").alias("version"))
        none = self.spark.createDataFrame([(None, None)], before.schema)
        left = touched if gone is None else touched.union(gone.select(self.part))
        listed = before.join(left, self.part, "left_anti").select(self.part, "version").union(now).union(none)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/live/of={version}")

    def _read(self, folder: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException:  # nothing there yet
            return None
