"""Replay of a file's rows: event times spread evenly (W2) and per-second
release pacing (W3, T6), with rows per file (A8).

Both need a row's position within its file and the file's totals. Those
come from :func:`tallyho.operators.running.row_index`, which splits a file
holding a large share of all rows over many tasks instead of one window
partition. Rows of equal sequence number are ordered by their record key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import first_field, parse_record_key
from ..functions.times import millis_instant, stamp_instant
from .running import in_pieces, row_index

# One file covers 15 minutes of feed; the release loop runs
# once per second.
INTERVAL_MINUTES = 15
SECONDS_PER_FILE = INTERVAL_MINUTES * 60


def spread_event_times(
    records: DataFrame,
    file_col: str = "file",
    seq_col: str = "seq",
    key_col: str = "record_key",
    interval_minutes: int = INTERVAL_MINUTES,
) -> DataFrame:
    """Give row i (1-based, by ``seq`` and key) of each file the event time
    ``start + (i - 1) * (interval_ms div lines)`` in epoch ms, where
    ``start`` is the first row's key stamp at minute precision (UTC).

    Adds ``line_no``, ``lines`` and ``event_ms``.
    """
    totals = {
        "lines": F.count(F.lit(1)),
        "first_key": F.min_by(F.col(key_col), F.struct(seq_col, key_col)),
    }
    indexed = row_index(records, [file_col], [seq_col, key_col], "line_no", totals=totals)
    return indexed.withColumn("event_ms", _event_ms(first_field("first_key", "-"), interval_minutes)).drop("first_key")


def _event_ms(stamp: Column | str, interval_minutes: int = INTERVAL_MINUTES) -> Column:
    """The event time of row ``line_no`` of ``lines``, in a file that starts at ``stamp``."""
    step = F.expr(f"CAST({interval_minutes * 60_000} AS BIGINT) div lines")
    return F.unix_millis(stamp_instant(stamp)) + (F.col("line_no") - F.lit(1)) * step


def pace_release(
    records: DataFrame,
    file_col: str = "file",
    seq_col: str = "seq",
    seconds: int = SECONDS_PER_FILE,
    key_col: str = "record_key",
) -> DataFrame:
    """Second (1..seconds) in which each row is released when every second
    sends ``queued div seconds_left`` rows (at least one second left).

    Closed form: the loop's batch sizes are the bucket sizes of
    ``ntile(seconds)`` over the rows in descending order, so for row i of L
    (ascending), with ``j = L - i``, ``q = L div R``, ``r = L mod R``:
    bucket = ``j div (q+1) + 1`` if ``j < r(q+1)`` else
    ``r + (j - r(q+1)) div q + 1``, and the release second is
    ``R + 1 - bucket``. Adds ``line_no``, ``lines``, ``release_second``.
    """
    indexed = row_index(
        records, [file_col], [seq_col, key_col], "line_no", totals={"lines": F.count(F.lit(1))}
    )
    r_sec = int(seconds)
    if r_sec < 1:
        raise ValueError("seconds must be >= 1")
    bucket = F.expr(
        f"""CASE WHEN (lines - line_no) < (lines % {r_sec}) * (lines div {r_sec} + 1)
                 THEN (lines - line_no) div (lines div {r_sec} + 1) + 1
                 ELSE (lines % {r_sec})
                      + ((lines - line_no) - (lines % {r_sec}) * (lines div {r_sec} + 1))
                        div greatest(lines div {r_sec}, 1)
                      + 1 END"""
    )
    return indexed.withColumn("release_second", (F.lit(r_sec + 1) - bucket).cast("int"))


def release_batch(paced: DataFrame, second: int) -> DataFrame:
    """Rows sent in one second of the replay (the queue split at n)."""
    return paced.where(F.col("release_second") == F.lit(second))


def release_counts(paced: DataFrame, file_col: str = "file") -> DataFrame:
    """(file, release_second, rows): batch size of every second that sends."""
    return paced.groupBy(file_col, "release_second").agg(F.count(F.lit(1)).alias("rows"))


def _stamped(lines: DataFrame, line_col: str) -> DataFrame:
    """(record_key, value, _stamp, _seq) of raw lines; _stamp is null where
    the record id has no time."""
    key = first_field(line_col)
    stamp = first_field("record_key", "-")
    return lines.select(key.alias("record_key"), F.col(line_col).alias("value")).select(
        "record_key",
        "value",
        F.when(stamp_instant(stamp).isNotNull(), stamp).alias("_segment"),
        parse_record_key("record_key")["key_seq"].alias("_seq"),
    )


def rejected_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """(record_key, value): the lines :func:`feed_records` can't publish,
    because their record id has no time."""
    return _stamped(lines, line_col).where(F.col("_segment").isNull()).select("record_key", "value")


def segment_ms(line_col: str = "value") -> Column:
    """When the segment of a raw line starts, in epoch ms; null where its record id has no time."""
    return F.unix_millis(stamp_instant(first_field(first_field(line_col), "-")))


def feed_records(lines: DataFrame, line_col: str = "value", path: str | None = None) -> DataFrame:
    """Raw feed lines -> (key, value, timestamp, event_ms): what the feeder
    publishes. ``key`` is the record id (first field), ``timestamp`` the
    event time from :func:`spread_event_times`. Lines without a time in their
    record id are left to :func:`rejected_lines`.

    A segment is identified by the stamp part of its record ids (every id
    in a segment file starts with the file's stamp), so the result does not
    depend on how the files were split into tasks; rows are ordered inside a
    segment by the id's sequence number.

    Whole lines are shuffled once: to sorted pieces, in which each row has its place
    (in a new folder, or over ``path``). What a piece adds to the places is one row for
    each segment in it, so there are no more of them than pieces and segments together.
    """
    records = _stamped(lines, line_col).where(F.col("_segment").isNotNull())
    rows = in_pieces(records, ["_segment"], ["_seq", "record_key"], path, place="_place")
    segment = Window.partitionBy("_segment")
    earlier = segment.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        rows.groupBy("_segment", "_piece")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .withColumn("lines", F.sum("_n").over(segment))
        .select("_segment", "_piece", "_shift", "lines")
    )
    placed = rows.join(F.broadcast(shares), ["_segment", "_piece"]).withColumn("line_no", F.col("_place") + F.col("_shift"))
    return placed.withColumn("event_ms", _event_ms("_segment")).select(
        F.col("record_key").alias("key"),
        "value",
        millis_instant("event_ms").alias("timestamp"),
        "event_ms",
    )
