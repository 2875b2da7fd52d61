"""Run a streaming query over a table replayed as a sequence of landings.

A table is cut into ``runs`` slices by ranges of an ordering column; each
slice is appended to a landing folder that a running query reads, and the next one
follows when all of it has been worked through. Or (``restarts``) the query is
started anew for each slice with ``trigger(availableNow=True)`` - the way a
scheduled job picks up the files that arrived since its last run. State,
watermark and the set of files already read live in the checkpoint, so each
run is one or more micro-batches continuing where the last one stopped, and a
lost executor or a restarted run replays from the checkpoint.

Sink rows are written by ``foreachBatch`` under ``batch=<id>`` with
overwrite, so a replayed batch replaces its own output (exactly once).
Everything is written below the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import configure, scratch_path

# Files of one micro-batch: bounds what one task of a stateful operator gets.
MAX_FILES = 1_000
# Each partition of a stateful operator opens, commits and uploads a store of its own in every
# batch, with rows or without: their number follows the cores, not the size of the input.
STATE_PARTITIONS = 32
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_conf(spark: SparkSession) -> None:
    """RocksDB state with changelog checkpointing: each batch uploads only
    the state changes, not whole snapshots, so large keyed state (one entry
    per pending mention) does not make commits slower as it grows. Stores are many and
    small, so none takes 4 MB for its log of files ahead."""
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[int]:
    """Queries that are started within get as many state partitions as there are cores,
    twice, but ``STATE_PARTITIONS`` at least, and no more than the shuffle partitions that
    are set. A query that goes on from a checkpoint keeps those it has."""
    key = "spark.sql.shuffle.partitions"
    given = spark.conf.get(key)
    number = min(int(given), max(STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism))
    spark.conf.set(key, str(number))
    try:
        yield number
    finally:
        spark.conf.set(key, given)


def slice_bounds(df: DataFrame, order_col: str, runs: int) -> list[tuple[int, int]]:
    """Equal-width [lo, hi) ranges of ``order_col`` (two numbers reach the
    driver: min and max)."""
    row = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    if row is None or row["lo"] is None:
        return []
    lo, hi = int(row["lo"]), int(row["hi"]) + 1
    step = max(1, -(-(hi - lo) // runs))
    return [(a, min(a + step, hi)) for a in range(lo, hi, step)]


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def replay_runs(
    spark: SparkSession,
    table: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    order_col: str = "event_id",
    runs: int = 4,
    output_mode: str = "append",
    sink: Callable[[str], Callable[[DataFrame, int], None]] = batch_writer,
    tag: str = "stream",
    heartbeat: str | None = None,
    restarts: bool = False,
    checkpoint: str | None = None,
    spread: bool = False,
) -> str:
    """Land ``table`` in ``runs`` slices for the stream ``build``, one when the
    last one is done; returns the sink folder (``batch=<id>`` sub-folders). Rows
    without an ordering value land with the first slice. ``restarts`` ends the query
    after each slice and goes on from its ``checkpoint``. ``spread`` deals the rows of a
    slice over files of equal size, some for each core: for wide rows, of which one file holds
    too many for a task.

    ``heartbeat`` names the event-time column of a last landing: one row that
    is null but for a time a day after the newest. It moves the watermark past
    all data, as a feed that has gone quiet does in production.
    """
    stream_conf(spark)
    landing = scratch_path(spark, f"{tag}-landing")
    checkpoint = checkpoint or scratch_path(spark, f"{tag}-checkpoint")
    out = scratch_path(spark, f"{tag}-out")
    schema = table.schema
    bounds = slice_bounds(table, order_col, runs)
    order = F.col(order_col)
    parts = [table.where((order >= lo) & (order < hi) | (F.lit(i == 0) & order.isNull())) for i, (lo, hi) in enumerate(bounds)]
    if heartbeat:
        last = table.agg(F.max(heartbeat).alias("t")).where("t is not null")
        beat = F.col("t") + F.expr("INTERVAL 1 DAY")
        parts.append(
            last.select(
                *(
                    (beat if f.name == heartbeat else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in schema.fields
                )
            )
        )
    def start(trigger: dict) -> StreamingQuery:
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", MAX_FILES).parquet(landing)
        writer = build(source).writeStream.outputMode(output_mode).foreachBatch(sink(out))
        with state_partitions(spark):
            return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    query = None
    try:
        for part in parts:
            if spread:
                part = part.repartition(min(4 * spark.sparkContext.defaultParallelism, MAX_FILES))
            part.write.mode("append").option("compression", "zstd").parquet(landing)
            if restarts:
                start({"availableNow": True}).awaitTermination()
            else:
                query = query or start({"processingTime": "0 seconds"})
                query.processAllAvailable()
    finally:
        if query:
            query.stop()
    return out


def read_sink(spark: SparkSession, out: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(out)
