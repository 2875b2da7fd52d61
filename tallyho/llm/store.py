"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyho.session import scratch_path


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path under ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"llm-{tag}")


def written(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors, and later readers see the same rows."""
    path = fresh_path(df.sparkSession, tag)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str:
    """Path of a shared folder as Python code in a task opens it.

    Operators that memory-map or write files need the shared folder to be
    mounted (NFS, a FUSE mount, or the same disk); other stores are refused.
    """
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"{uri}: this operator needs spark.checkpoint.dir on a mounted path")
    return uri
