"""Sinks: compacted Parquet copies and topic writers.

Topic (Kafka) sinks need the ``spark-sql-kafka`` package on the classpath,
which this environment does not have; those functions only build the
writer and are untested here.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrivals import local_folder


def compact(
    df: DataFrame,
    path: str,
    files: int | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """Rewrite many small inputs as fewer, larger Parquet files (S17).

    Default: the ``rebalance`` hint, so adaptive execution sizes the output
    partitions to ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (split
    where large, merged where small) and the file count follows the data
    volume. ``files`` asks for an exact count instead (``repartition``).
    Either way one shuffle; ``maxRecordsPerFile`` also caps a file. Returns
    ``path``.
    """
    shaped = df.repartition(int(files)) if files else df.hint("rebalance")
    writer = shaped.write.mode("errorifexists")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.parquet(path)
    return path


EVENT_TIME_HEADER = "event_time_us"
HEADERS_TYPE = "array<struct<key:string,value:binary>>"


def kafka_records(
    df: DataFrame,
    key_col: str,
    value_col: str,
    topic: str,
    partition: int | None = None,
    event_time: str | None = None,
) -> DataFrame:
    """Shape rows for the Kafka sink: key, value (strings), topic, partition.
    The sink has no timestamp column, so the event time travels in a header,
    as decimal microseconds (:func:`topic_records` reads it back)."""
    cols = [
        F.col(key_col).cast("string").alias("key"),
        F.col(value_col).cast("string").alias("value"),
        F.lit(topic).alias("topic"),
    ]
    if event_time is not None:
        us = F.unix_micros(event_time).cast("string").cast("binary")
        header = F.array(F.struct(F.lit(EVENT_TIME_HEADER).alias("key"), us.alias("value")))
        cols.append(F.when(us.isNotNull(), header).cast(HEADERS_TYPE).alias("headers"))
    if partition is not None:
        cols.append(F.lit(int(partition)).alias("partition"))
    return df.select(*cols)


def write_topic(df: DataFrame, servers: str, checkpoint: str):
    """Start a streaming Kafka sink for rows shaped by :func:`kafka_records`."""
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .start()
    )


def read_topic(spark, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Streaming Kafka source of (key, value, timestamp) strings.
    ``starting='latest'`` reads only records published after the start."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("includeHeaders", "true")
        .load()
    )
    return topic_records(raw)


def topic_records(raw: DataFrame) -> DataFrame:
    """Rows of the Kafka source (with headers) -> (key, value, timestamp): the
    event time of :func:`kafka_records`, or the broker's time where a record
    has none."""
    ours = F.filter("headers", lambda h: h["key"] == EVENT_TIME_HEADER)
    event_us = F.get(ours, 0)["value"].cast("string").try_cast("bigint")
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.coalesce(F.timestamp_micros(event_us), F.col("timestamp")).alias("timestamp"),
    )


def land_segments(lines: DataFrame, folder: str, file_col: str = "file_name", line_col: str = "line") -> int:
    """Write each segment's lines to a text file of its name, and return the number
    of files. A file is written under another name by one task, line by line, and
    then renamed, so it appears whole, and a repeated task puts the same in its
    place. The folder must be on a path mounted on all machines."""
    folder = local_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, done = None, None, 0

        def close() -> None:
            if file:
                file.close()
                os.replace(file.name, os.path.join(folder, name))

        for batch in batches:
            for own, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != name:
                    close()
                    os.makedirs(folder, exist_ok=True)
                    name, done = own, done + 1
                    file = open(os.path.join(folder, f".{own}.{uuid.uuid4().hex}"), "w", encoding="utf-8", newline="\n")  # noqa: SIM115
                file.write(f"{line}\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["files"])

    rows = lines.where(F.col(file_col).isNotNull()).select(file_col, F.coalesce(F.col(line_col).cast("string"), F.lit("")).alias(line_col))
    sorted_ = rows.repartition(file_col).sortWithinPartitions(file_col, line_col)
    return sorted_.mapInArrow(run, "files bigint").agg(F.sum("files")).first()[0] or 0
