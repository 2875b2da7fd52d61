"""The streaming application end to end, as it runs in production.

The feeder publishes records (key = record id, value = feed line, timestamp =
assigned event time), here as Parquet appended to a folder, one sub-folder per
segment; a Kafka topic written with the event time in a header and read with
:func:`tallyho.sources.sinks.read_topic` has the same three columns.
Two streaming queries follow, one on the output of the other:

* ``mentions``: the parsed (record_key, position, name, ts) rows, appended
  to ``<root>/mentions`` (the intermediate topic of the original, S12); their
  event_id follows from the first two and is made when they are read;
* ``counter``: reads the mentions that are committed there, so records are parsed
  once: the trailing-hour counts of all names in keyed state (R2, R3), and
  their bounded leaderboard (R6, R7, R8, S15) under ``<root>/board``.

The mentions folder keeps a log of the files of each batch: a batch that is run
again commits nothing twice, and readers see only committed files. Each
query has its own checkpoint under ``<root>/checkpoints``, so either one
can be stopped, restarted or lose executors without affecting the other; with
the log and the overwrite of a batch's own board both outputs are
exactly once. ``maxFilesPerTrigger`` bounds a micro-batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import first_field
from ..operators.board import BOARD_SIZE
from ..sources.feed import mention_id, record_positions
from .board import BOARD_SCHEMA, board_sink
from .runner import MAX_FILES, state_partitions, stream_conf
from .trailing import board_stream

RECORD_SCHEMA = "key string, value string, timestamp timestamp, segment string"


def publish(records: DataFrame, topic_path: str) -> None:
    """Append feeder output (key, value, timestamp) to the record folder, a
    sub-folder per segment (the stamp of its record ids). Segments that are
    there already are left out, so a poll that is repeated, or offers a file
    again, publishes nothing twice."""
    spark = records.sparkSession
    new = records.select("key", "value", "timestamp", first_field("key", "-").alias("segment"))
    try:
        there = spark.read.schema(RECORD_SCHEMA).parquet(topic_path).select("segment").distinct()
    except AnalysisException:  # nothing published yet
        pass
    else:
        # a name for each segment: fewer than the files that the driver has listed
        new = new.join(F.broadcast(there), "segment", "left_anti").select("key", "value", "timestamp", "segment")
    new.write.mode("append").partitionBy("segment").option("compression", "zstd").parquet(topic_path)


def records_source(spark: SparkSession, topic_path: str, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """Streaming source over the record folder."""
    reader = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(topic_path).select("key", "value", "timestamp")


MENTIONS_SCHEMA = "record_key string, position int, name string, ts timestamp"


def start(
    spark: SparkSession,
    records: DataFrame,
    root: str,
    board_size: int = BOARD_SIZE,
    strip: str = "last",
    available_now: bool = False,
    processing_time: str | None = None,
) -> dict[str, StreamingQuery]:
    """Start the mentions tee on ``records`` and the counter/board query on its output.

    ``available_now`` processes what is there and stops (a scheduled run; the counter
    starts when the tee is done); otherwise the queries run on
    ``processing_time`` (default: as fast as data arrives).
    """
    stream_conf(spark)

    def trigger(writer):
        if available_now:
            return writer.trigger(availableNow=True)
        if processing_time:
            return writer.trigger(processingTime=processing_time)
        return writer

    tee = trigger(
        record_positions(records, strip)
        .writeStream.format("parquet")
        .option("compression", "zstd")
        .option("path", f"{root}/mentions")
        .option("checkpointLocation", f"{root}/checkpoints/mentions")
        .outputMode("append")
        .queryName("mentions")
    ).start()
    if available_now:
        tee.awaitTermination()
    source = spark.readStream.schema(MENTIONS_SCHEMA).option("maxFilesPerTrigger", MAX_FILES)
    mentions = source.parquet(f"{root}/mentions")
    with state_partitions(spark):
        counter = trigger(
            board_stream(mentions.select("name", "ts"), board_size, packed=True)
            .writeStream.foreachBatch(board_sink(board_size)(f"{root}/board"))
            .option("checkpointLocation", f"{root}/checkpoints/counter")
            .queryName("counter")
        ).start()
    return {"mentions": tee, "counter": counter}


def read_mentions(spark: SparkSession, root: str) -> DataFrame:
    """(event_id, record_key, name, ts): the mentions that are committed."""
    rows = spark.read.schema(MENTIONS_SCHEMA).parquet(f"{root}/mentions")
    return rows.select(mention_id(), "record_key", "name", "ts")


def newest_board(spark: SparkSession, root: str) -> DataFrame:
    """(rank, name, n) after the last batch of the counter."""
    boards = spark.read.schema(BOARD_SCHEMA).parquet(f"{root}/board/board")
    last = boards.agg(F.max("batch").alias("batch"))
    return boards.join(F.broadcast(last), "batch").select("rank", "name", "n")  # one row
