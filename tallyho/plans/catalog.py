"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them) in
full, so its work grows with the tables. Column names equal those of the
SQL twin in :mod:`tallyho.plans.oracle`. Timestamps are returned as
``timestamp_ntz`` (UTC wall time), like the tables they come from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import is_name, name_tokens, strip_offset
from ..functions.times import as_instant, segment_name, slot_end, slot_start, stamp_instant
from ..functions.keys import first_field
from ..operators import board, increments, replay, segments, topnames, trailing
from ..session import configure, drop_scratch, scratch_path, shuffles_dropped
from ..sources import arrivals, feed, fixtures, packing, rejects, sinks, upserts
from ..streaming import board as stream_board
from ..streaming import pipeline, runner, sliding, stored
from ..streaming import trailing as stream_trailing

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.articles(_documents(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return fixtures.table(spark, sf_dir, "events").select("event_id", "ts", "user_id")


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.mentions(_events(spark, sf_dir))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.keyed_lines(_events(spark, sf_dir))


# ---- top names (documents feed) -----------------------------------------


def top_names_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topnames.top_names_per_day(_articles(spark, sf_dir), k=10)


def name_counts_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topnames.count_names(topnames.explode_names(_articles(spark, sf_dir)))


def top_names_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topnames.top_lists(top_names_per_day(spark, sf_dir))


def first_days_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topnames.first_days(top_names_per_day(spark, sf_dir), days=5)


def top_names_first_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topnames.top_names_per_day(_articles(spark, sf_dir), k=10, strip="first")


def strip_first_vs_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = _articles(spark, sf_dir).select("day", F.explode(name_tokens("AllNames")).alias("tok"))
    last = strip_offset("tok", "last")
    first = strip_offset("tok", "first")
    return toks.where(F.col("tok") != "").groupBy("day").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_if(last != first).alias("differing"),
    )


def noise_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = _articles(spark, sf_dir).select("day", F.explode(name_tokens("AllNames")).alias("tok"))
    name = strip_offset("tok", "last")
    empty = name == F.lit("")
    return toks.groupBy("day").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_if(empty).alias("empty_names"),
        F.count_if(~empty & ~is_name(name)).alias("noise_names"),
        F.count_if(is_name(name)).alias("kept_names"),
    )


def _landed_feed(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    path = scratch_path(spark, "feed")
    return fixtures.write_feed_files(_documents(spark, sf_dir), path, compression)


def feed_file_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed TSV scan of landed feed files -> top names per day."""
    path = _landed_feed(spark, sf_dir)
    rows = feed.read_typed(spark, path, glob_filter="*.txt", recursive=True)
    return topnames.top_names_per_day(feed.articles_from_typed(rows), k=10)


def feed_view_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed view of feed rows from another source (columns in another
    order, a narrower number type) -> top names per day."""
    rows = fixtures.feed_rows(_documents(spark, sf_dir)).drop("short")
    other = rows.select(
        *(F.col(c).cast("smallint") if c == "SourceCollectionIdentifier" else F.col(c) for c in reversed(rows.columns))
    )
    return topnames.top_names_per_day(feed.articles_from_typed(feed.as_feed(other)), k=10)


def feed_line_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-line scan of landed feed files -> top names per day."""
    path = _landed_feed(spark, sf_dir)
    lines = feed.read_lines(spark, path, glob_filter="*.txt", recursive=True)
    return topnames.top_names_per_day(feed.articles_from_lines(lines), k=10)


def feed_line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_feed(spark, sf_dir)
    return feed.line_report(feed.read_lines(spark, path, glob_filter="*.txt", recursive=True))


def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines that the feeder can't publish, for want of a time."""
    path = _landed_feed(spark, sf_dir)
    lines = feed.read_lines(spark, path, glob_filter="*.txt", recursive=True)
    return replay.rejected_lines(lines).select("record_key")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by reason, as counted while they were split, and as the channels hold them."""
    configure(spark)
    lines = feed.read_lines(spark, _landed_feed(spark, sf_dir), glob_filter="*.txt", recursive=True)
    out = scratch_path(spark, "channels")
    counted = rejects.split_lines(lines, out)
    seen = spark.createDataFrame(list(counted.items()), "reason string, seen long")  # one row for each reason
    held = [
        read.select(F.explode(F.concat(F.array(F.lit(rejects.LINES), *extra), F.col("reasons"))).alias("of"))
        for read, extra in (
            (rejects.read_channel(spark, out, rejects.LINES), ()),
            (rejects.read_channel(spark, out, rejects.REJECTS), (F.lit(rejects.REJECTS),)),
        )
    ]
    written = held[0].union(held[1]).groupBy("of").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(written, F.col("reason") == F.col("of"), "left").select(
        "reason", "seen", F.coalesce("n", F.lit(0).cast("long")).alias("held")
    )


# ---- record keys and segments (events) ----------------------------------


def record_key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.record_key_parts(fixtures.edge_keys(_events(spark, sf_dir))).select(
        "event_id", "record_key", "key_ts", "key_seq"
    )


def last_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.last_record_key(fixtures.edge_keys(_events(spark, sf_dir)))


def slot_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _keyed(spark, sf_dir)
    return k.select(
        "event_id",
        slot_start("ts").alias("slot_start"),
        slot_end("ts").alias("slot_end"),
        segment_name(slot_start("ts")).alias("segment"),
        stamp_instant(first_field("record_key", "-")).alias("key_minute"),
    ).select("event_id", _ntz("slot_start"), _ntz("slot_end"), "segment", _ntz("key_minute"))


def expected_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.expected_segments(segments.landed_segments(_mentions(spark, sf_dir)))


def missing_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = segments.landed_segments(_mentions(spark, sf_dir))
    return segments.missing_segments(segments.expected_segments(landed), landed)


def new_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.new_segments(segments.landed_segments(_mentions(spark, sf_dir)))


def segment_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls: the first sees the segments of the first half of the time
    and offers those after a mark in their middle; the second sees all and goes on from the
    first's mark."""
    landed = segments.landed_segments(_mentions(spark, sf_dir))
    ranked = landed.agg(F.array_sort(F.collect_set("file_name")).alias("a"))  # one name per 15 minutes
    cut = ranked.select(F.get("a", F.expr("size(a) div 2")), F.get("a", F.expr("size(a) div 4"))).first()
    first = segments.new_segments(landed.where(F.col("file_name") <= cut[0]), cut[1])
    mark = first.agg(F.max("next_mark")).first()[0] or cut[1]
    second = segments.new_segments(landed, mark)
    return first.select(F.lit(1).alias("poll"), "*").union(second.select(F.lit(2).alias("poll"), "*"))


# ---- replay (events as 15-minute files) ---------------------------------


def _replay_records(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    k = _keyed(spark, sf_dir)
    file = F.date_format("ts", "yyyyMMdd") if by_day else segment_name(slot_start("ts"))
    return k.select(file.alias("file"), F.col("event_id").alias("seq"), "event_id", "record_key")


def event_time_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = replay.spread_event_times(_replay_records(spark, sf_dir))
    return spread.select("event_id", "file", "line_no", "lines", "event_ms")


def replay_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paced = replay.pace_release(_replay_records(spark, sf_dir, by_day=True))
    return paced.select("event_id", "file", "release_second")


def replay_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    paced = replay.pace_release(_replay_records(spark, sf_dir, by_day=True))
    return replay.release_counts(paced)


# ---- trailing counts and the board (events as mentions) ------------------


def trailing_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = trailing.trailing_changelog(_mentions(spark, sf_dir))
    return log.select("name", "event_id", "kind", _ntz("change_ts"), "n")


def trailing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = trailing.trailing_changelog(_mentions(spark, sf_dir))
    return trailing.arrival_counts(log).select("name", "event_id", _ntz("ts"), "n")


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts at the end of the data, from its last hour: the scan's
    filter is on the stored column, so it is pushed down."""
    events = _events(spark, sf_dir)
    as_of = events.agg(F.max("ts")).first()[0] or dt.datetime(1970, 1, 1)
    live = trailing.live_counts(events.withColumn("name", F.col("user_id")), as_of)
    return live.select(fixtures.name_of("name").alias("name"), "n")


def latest_per_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir)


def board_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.board(_latest(spark, sf_dir), 100)


def board_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.board_floor(board.board(_latest(spark, sf_dir), 100))


def board_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole board as the one JSON message a new subscriber gets."""
    return board.snapshot_message(board.board(_latest(spark, sf_dir), 100))


def _delta_messages(spark: SparkSession, sf_dir: str, every_seconds: int) -> DataFrame:
    log = trailing.trailing_changelog(_mentions(spark, sf_dir))
    msgs = board.delta_messages(board.coalesce_deltas(log, every_seconds))
    return msgs.select(_ntz("bucket"), "part", "entries", "message")


def board_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delta_messages(spark, sf_dir, 3600)


def flush_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a flush every second sends."""
    return _delta_messages(spark, sf_dir, 1)


# ---- sinks ---------------------------------------------------------------


def compacted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rewritten as a compacted Parquet copy, then counted per type."""
    configure(spark)
    events = fixtures.table(spark, sf_dir, "events")
    path = sinks.compact(events, scratch_path(spark, "compacted"))
    copy = spark.read.parquet(path)
    return copy.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def packed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that land in small files in two turns, packed after each, then counted per
    type. The size of a file is a quarter of what has landed first."""
    configure(spark)
    events = fixtures.table(spark, sf_dir, "events")
    folder = scratch_path(spark, "packed")
    target = None
    for half in (0, 1):
        part = events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        # as a feed lands: a file for each of many short times
        part.repartition(16, F.xxhash64("event_id")).write.mode("append").parquet(folder)
        target = target or max(1, (packing.live_files(spark, folder).agg(F.sum("bytes")).first()[0] or 0) // 4)
        packing.pack(spark, folder, events.schema, target)
    return packing.read_packed(spark, folder, events.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


# ---- tables that follow what lands ---------------------------------------


def incremental_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top names per day, kept up as segments land: an article's segment is one of 96 of its
    day. A first run gets those of the first half of the days, every fourth with rows
    that are missing and rows that are there twice; a second one gets the others, and those
    again as they should be."""
    documents = _documents(spark, sf_dir)
    slot = F.pmod(F.col("doc_id").cast("long") * 31, F.lit(96))
    parts = documents.select("doc_id", "text", slot.alias("slot"))
    stale = F.pmod("slot", F.lit(4)) == 0
    twice = F.when(stale & (F.pmod("doc_id", F.lit(3)) == 0), F.array().cast("array<int>"))
    twice = twice.when(stale & (F.pmod("doc_id", F.lit(3)) == 1), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    first = parts.where("slot < 48").withColumn("copy", F.explode(twice)).drop("copy")
    second = parts.where((F.col("slot") >= 48) | stale)
    counts = increments.DailyCounts(spark, scratch_path(spark, "daily"))
    for number, offered in enumerate((first, second), 1):
        # The segment of an article whose date doesn't parse has none of its mentions.
        rows = fixtures.articles(offered, "slot").withColumn("segment", F.format_string("%s-%02d", F.col("day").cast("string"), "slot"))
        counts.offer(number, rows.select("segment"), topnames.explode_names(rows, keep=("segment", "day")))
    return counts.top().select("day", "rank", "name", "n")


def upserted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts at the end of the data: the changelog's last counts of each of four times
    are upserted one after the other; the table is compacted to the second's after the
    third, as a compaction that ran meanwhile."""
    log = trailing.trailing_changelog(_mentions(spark, sf_dir))
    bounds = _events(spark, sf_dir).agg(F.unix_micros(as_instant(F.min("ts"))), F.unix_micros(as_instant(F.max("ts")))).first()
    lo, hi = bounds[0] or 0, bounds[1] or 0
    held = scratch_path(spark, "upserts-log")
    log.withColumn("at", F.unix_micros("change_ts")).where(F.col("at") <= hi).write.parquet(held)
    log = spark.read.parquet(held)
    table = upserts.LatestCounts(spark, scratch_path(spark, "upserts"))
    edges = [lo + (hi + 1 - lo) * k // 4 for k in range(5)]
    for number, (a, b) in enumerate(zip(edges, edges[1:], strict=False), 1):
        table.upsert(number if number < 4 else 5, board.last_counts(log.where((F.col("at") >= a) & (F.col("at") < b))))
        if number == 3:
            table.compact(4, upto=2)
    return table.read()


QUERIES: dict[str, Query] = {
    "top_names_per_day": top_names_per_day,
    "name_counts_per_day": name_counts_per_day,
    "top_names_list": top_names_list,
    "first_days_top": first_days_top,
    "top_names_first_comma": top_names_first_comma,
    "strip_first_vs_last": strip_first_vs_last,
    "noise_filtered": noise_filtered,
    "feed_file_top_names": feed_file_top_names,
    "feed_view_top_names": feed_view_top_names,
    "feed_line_top_names": feed_line_top_names,
    "feed_line_report": feed_line_report,
    "record_key_parts": record_key_parts,
    "last_record_key": last_record_key,
    "slot_bounds": slot_bounds,
    "expected_segments": expected_segments,
    "missing_segments": missing_segments,
    "new_segments": new_segments,
    "segment_polls": segment_polls,
    "feed_rejects": feed_rejects,
    "reject_reasons": reject_reasons,
    "event_time_spread": event_time_spread,
    "replay_pacing": replay_pacing,
    "replay_batches": replay_batches,
    "trailing_changelog": trailing_changelog,
    "trailing_count": trailing_count,
    "latest_per_name": latest_per_name,
    "board_100": board_100,
    "board_floor": board_floor,
    "board_snapshot": board_snapshot,
    "board_deltas": board_deltas,
    "flush_deltas": flush_deltas,
    "compacted_counts": compacted_counts,
    "packed_counts": packed_counts,
    "incremental_top_names": incremental_top_names,
    "upserted_counts": upserted_counts,
}


# ---- streams (events replayed in 4 landings, availableNow per landing) ----

# Rows land up to 9 minutes late, inside the watermark's 10 minutes.
LATEST_SECONDS = 540


def _stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with their arrival: late by a fixed rule, so that rows of one
    name come out of order within and across landings."""
    late = F.pmod(F.col("event_id") * 7919, F.lit(LATEST_SECONDS)) * 1_000_000
    events = _events(spark, sf_dir)
    return events.withColumn("arrival_us", F.unix_micros(as_instant("ts")) + late)


def hourly_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runner.replay_runs(
        spark,
        _stream_table(spark, sf_dir),
        lambda src: sliding.slot_counts(fixtures.mentions(src), "5 minutes", "1 hour"),
        order_col="arrival_us",
        output_mode="update",
        tag="sliding",
    )
    slots = sliding.final_counts(runner.read_sink(spark, out))
    final = sliding.window_counts(slots, 60, 5)
    return final.select(_ntz("window_start"), _ntz("window_end"), "name", "n")


def _trailing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runner.replay_runs(
        spark,
        _stream_table(spark, sf_dir),
        lambda src: stream_trailing.trailing_stream(fixtures.mentions(src)),
        order_col="arrival_us",
        sink=stream_trailing.changelog_sink,
        tag="trailing",
        heartbeat="ts",
    )
    return runner.read_sink(spark, out)


def stateful_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _trailing_log(spark, sf_dir)
    return trailing.arrival_counts(log).select("name", "event_id", _ntz("ts"), "n")


def stateful_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals and expiries of the stream, for rows that land out of order."""
    return _trailing_log(spark, sf_dir).select("name", "event_id", "kind", _ntz("change_ts"), "n")


def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a flush every second sends, from the stream's state."""
    out = runner.replay_runs(
        spark,
        _stream_table(spark, sf_dir),
        lambda src: stream_trailing.flush_stream(fixtures.mentions(src)),
        order_col="arrival_us",
        sink=stream_board.flush_sink,
        tag="flush",
        heartbeat="ts",
    )
    return runner.read_sink(spark, out).select(_ntz("bucket"), "part", "entries", "message")


def stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live counts in the state of a stream that was started anew for the
    second landing, read from its checkpoint: those at the last watermark."""
    configure(spark)
    checkpoint = scratch_path(spark, "stored-checkpoint")
    runner.replay_runs(
        spark,
        _stream_table(spark, sf_dir),
        lambda src: stream_trailing.trailing_stream(fixtures.mentions(src)),
        order_col="arrival_us",
        sink=stream_trailing.changelog_sink,
        runs=2,
        tag="stored",
        restarts=True,
        checkpoint=checkpoint,
    )
    return stored.stored_counts(spark, checkpoint)


def segment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``segment_polls`` on a stream: the mentions land in a file for each segment, up to
    the middle of the time first; one run of the query offers those after the mark, and a
    second one, from the first's checkpoint, what has landed since."""
    rows = _mentions(spark, sf_dir).withColumn("file_name", segment_name(slot_start("ts")))
    names = rows.agg(F.array_sort(F.collect_set("file_name")).alias("a"))  # one name per 15 minutes
    cut = names.select(F.get("a", F.expr("size(a) div 2")), F.get("a", F.expr("size(a) div 4"))).first()
    landing, checkpoint, out = (scratch_path(spark, f"segments-{x}") for x in ("landing", "checkpoint", "out"))
    seen = F.col("file_name") <= cut[0]
    for poll, part in enumerate((rows.where(seen), rows.where(~seen)), 1):
        sinks.land_segments(part.withColumn("line", F.concat_ws("\t", "event_id", "name")), landing)
        query = (
            arrivals.arriving_segments(spark, landing, cut[1])
            .withColumn("poll", F.lit(poll))
            .writeStream.foreachBatch(runner.batch_writer(f"{out}/poll={poll}"))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    offered = spark.read.schema("poll int, batch long, file_name string, late boolean").parquet(out)
    marks = offered.groupBy(F.col("poll").alias("of")).agg(F.max("file_name").alias("next_mark"))
    return offered.where("not late").join(marks, F.col("poll") == F.col("of")).select("poll", "file_name", "next_mark")


def _board_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runner.replay_runs(
        spark,
        _stream_table(spark, sf_dir),
        lambda src: stream_trailing.board_stream(fixtures.mentions(src), 100),
        order_col="arrival_us",
        sink=stream_board.board_sink(100),
        tag="board",
    )
    return stream_board.delta_steps(spark, out)


def board_evictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that entered, changed or left (0) the board at each landing."""
    return _board_deltas(spark, sf_dir)


def stream_board_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board at each landing's watermark, put together from the deltas."""
    return stream_board.boards_from_deltas(_board_deltas(spark, sf_dir))


def feed_stream_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline on the landed feed: the feeder gives each line an
    event time and publishes (key, value, timestamp) records (written once,
    like a topic); the stream parses them into mentions (R1) and counts names
    per 15 minutes of the assigned event time with a watermark (R4, R9); the
    top 10 names of every sliding hour are ranked from the final counts."""
    configure(spark)
    lines = feed.read_lines(spark, _landed_feed(spark, sf_dir), glob_filter="*.txt", recursive=True)
    topic = scratch_path(spark, "feed-records")
    replay.feed_records(lines).write.mode("errorifexists").option("compression", "zstd").parquet(topic)
    out = runner.replay_runs(
        spark,
        spark.read.parquet(topic),
        lambda src: sliding.slot_counts(feed.record_mentions(src), "15 minutes", "1 hour"),
        order_col="event_ms",
        output_mode="update",
        tag="feed-stream",
        spread=True,
    )
    final = sliding.window_counts(sliding.final_counts(runner.read_sink(spark, out)), 60, 15)
    top = topnames.rank_top(final, 10, by=("window_start", "window_end"))
    return top.select(_ntz("window_start"), _ntz("window_end"), "rank", "name", "n")


def stream_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of the application after two runs, the second from the first's
    checkpoints, each on two polls of the feeder, and one with nothing new: the top 10 names of each sliding hour from
    the mentions topic (S12), and the counter's board at its watermark (``window_start``
    null)."""
    configure(spark)
    landed = _landed_feed(spark, sf_dir, "gzip")
    lines = feed.read_lines(spark, landed, glob_filter="*.txt.gz", recursive=True).withColumn("start_ms", replay.segment_ms())
    topic, root, pieces = (scratch_path(spark, f"outputs-{x}") for x in ("topic", "app", "pieces"))
    start_ms = F.col("start_ms")
    slices = [lines.where((start_ms >= lo) & (start_ms < hi)) for lo, hi in runner.slice_bounds(lines, "start_ms", 4)]
    for poll, part in enumerate([*slices, lines.limit(0)], 1):
        # each poll's segments go through the same folder of pieces, to the topic
        with shuffles_dropped(spark):
            pipeline.publish(replay.feed_records(part, path=pieces), topic)
        drop_scratch(spark, pieces)
        if poll == len(slices):  # the topic has the whole feed
            drop_scratch(spark, landed)
        if poll % 2 and poll < len(slices):
            continue
        queries = pipeline.start(spark, pipeline.records_source(spark, topic), root, available_now=True)
        queries["counter"].awaitTermination()
    mentions = pipeline.read_mentions(spark, root).select(slot_start("ts").alias("slot_start"), "name")
    slots = mentions.groupBy("slot_start", "name").agg(F.count(F.lit(1)).alias("n"))
    # Dealt by name, a few rows for each, so the windows' sums need no shuffle of all windows.
    windows = sliding.window_counts(slots.repartition("name"), 60, 15)
    top = topnames.rank_top(windows, 10, by=("window_start", "window_end"))
    board_rows = pipeline.newest_board(spark, root).withColumn("window_start", F.lit(None).cast("timestamp"))
    columns = [_ntz("window_start"), "rank", "name", "n"]
    return top.select(*columns).union(board_rows.select(*columns))


QUERIES.update(
    {
        "feed_stream_top": feed_stream_top,
        "stream_outputs": stream_outputs,
        "hourly_sliding_counts": hourly_sliding_counts,
        "stateful_trailing": stateful_trailing,
        "stateful_changelog": stateful_changelog,
        "stream_flush": stream_flush,
        "stored_counts": stored_counts,
        "segment_stream": segment_stream,
        "board_evictions": board_evictions,
        "stream_board": stream_board_100,
    }
)
