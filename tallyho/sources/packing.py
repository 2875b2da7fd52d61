"""Compaction that leaves large files alone (S17): small Parquet files of a folder are packed
into files of about a given size, and a list of what they replace is swapped in.

Files land in the folder as they come. A run takes the files below half the size, fills bins
with them in order of their path, and writes each bin of two or more as one file under
``_packed/run=<n>``; then the list ``_packed/replaced/run=<n>`` of the files that it packed is
written, in one file, and with that the run counts. Readers take the folder's files
and those of the runs that count, without the replaced ones. So a reader sees each row once
whenever it looks, a run that failed leaves nothing, and a second run over an unchanged folder
has nothing to do. Replaced files stay for readers that began before; they may be removed
later.

The files' names and sizes are listed by Spark; a reader needs them on the driver, as any
scan of the folder does. Their rows are read once, by bins.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES = 512 * 1024 * 1024


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, uri, bytes) of the Parquet files below a folder; contents aren't read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    try:
        rows = reader.load(folder)
    except AnalysisException:  # nothing there yet
        return spark.createDataFrame([], "path string, uri string, bytes long")
    return rows.select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"))


def _replaced(spark: SparkSession, folder: str) -> DataFrame:
    """(uri, run) of the files that runs have replaced."""
    schema = "uri string, run long"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/_packed/replaced")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def live_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, uri, bytes): the files that hold the folder's rows now, each row once."""
    replaced = _replaced(spark, folder)
    packed = _listed(spark, f"{folder}/_packed/data").withColumn("run", F.regexp_extract("uri", "/run=([0-9]+)/", 1).cast("long"))
    counting = packed.join(replaced.select("run").distinct(), "run", "left_semi").drop("run")
    return _listed(spark, folder).union(counting).join(replaced, "uri", "left_anti").select("path", "uri", "bytes")


def read_packed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    paths = [r["path"] for r in live_files(spark, folder).select("path").collect()]  # as any scan of files does
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def pack(spark: SparkSession, folder: str, schema: T.StructType, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the small files once; the number of files that were replaced."""
    run = (_replaced(spark, folder).agg(F.max("run")).first()[0] or 0) + 1
    small = live_files(spark, folder).where(F.col("bytes") < target_bytes / 2)
    # One row for each small file.
    binned = small.withColumn("bin", F.expr(f"(sum(bytes) OVER (ORDER BY path) - bytes) div {int(target_bytes)}"))
    binned = binned.withColumn("of_bin", F.count("*").over(Window.partitionBy("bin"))).where("of_bin > 1")
    held = binned.select("path", "uri", "bin").collect()
    if not held:
        return 0
    bins = spark.createDataFrame([(r["uri"], r["bin"]) for r in held], "_uri string, _bin long")
    rows = spark.read.schema(schema).parquet(*(r["path"] for r in held)).select("*", F.col("_metadata.file_path").alias("_uri"))
    # A bin is one task and one file, of at most the size and one small file.
    rows.join(bins, "_uri").drop("_uri").repartition(len({r["bin"] for r in held}), "_bin").write.partitionBy("_bin").mode(
        "overwrite"
    ).parquet(f"{folder}/_packed/data/run={run}")
    bins.select(F.col("_uri").alias("uri")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/_packed/replaced/run={run}")
    return len(held)
