"""Session set-up shared by tests, bench and the registered queries."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
import uuid

from pyspark.sql import SparkSession

# Runtime settings every query relies on. Data times are UTC; AQE re-plans
# shuffles (partition coalescing, skew splits in joins) from runtime sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of whole texts are wide: smaller batches bound a Python worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library assumes (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app: str = "tallyho",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the job and is visible to every
    executor. Only when it is unset (local tests) a folder is made here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):  # one machine, one process
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyho-ckpt-"))
    else:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach "
            "(streams, board batches and landed copies are written there)"
        )
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return os.path.join(_scratch_root(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "tallyho", spark.sparkContext.applicationId)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action that is run within go when it ends, not when the driver
    happens to collect its garbage: for writes of wide rows, whose plans are run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if given is None else spark.conf.set(key, given)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this application. Results that weren't
    written elsewhere can't be read any more."""
    _remove(spark, _scratch_root(spark))


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one scratch folder of this application, all of whose rows have been written
    elsewhere: nothing that is still to run may read it."""
    if os.path.dirname(path) != _scratch_root(spark) or not os.path.basename(path).strip("."):
        raise ValueError(f"{path} is no scratch folder of this application")
    _remove(spark, path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
