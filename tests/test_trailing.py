"""Trailing counts: batch changelog cases, board, and stream/batch parity."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tallyho.operators import board, trailing
from tallyho.sources import fixtures
from tallyho.streaming import board as stream_board
from tallyho.streaming import runner
from tallyho.streaming import trailing as stream_trailing

T0 = dt.datetime(2015, 2, 18, 0, 0)


def _mentions(spark, rows):
    return spark.createDataFrame(rows, "event_id long, name string, ts timestamp")


def test_counts_rise_and_fall(spark):
    m = _mentions(spark, [(i, "Ann", T0 + dt.timedelta(minutes=10 * i)) for i in range(3)])
    log = trailing.trailing_changelog(m).orderBy("change_ts", "n").collect()
    assert [(r["kind"], r["n"]) for r in log] == [
        ("arrival", 1), ("arrival", 2), ("arrival", 3), ("expiry", 2), ("expiry", 1), ("expiry", 0)
    ]
    assert [r["change_ts"] for r in log][3:] == [T0 + dt.timedelta(minutes=m) for m in (60, 70, 80)]


def test_half_open_boundary(spark):
    m = _mentions(spark, [(0, "Ann", T0), (1, "Ann", T0 + dt.timedelta(minutes=60))])
    arrivals = trailing.arrival_counts(trailing.trailing_changelog(m)).orderBy("ts").collect()
    assert [r["n"] for r in arrivals] == [1, 1]


def test_board_and_floor(spark):
    latest = spark.createDataFrame(
        [(f"n{i:03d}", i % 7) for i in range(150)], "name string, n long"
    )
    b = board.board(latest, 100)
    rows = b.orderBy("rank").collect()
    assert len(rows) == 100 and rows[0]["n"] == 6 and rows[0]["name"] == "n006"
    fl = board.board_floor(b).first()
    assert fl["entries"] == 100 and fl["floor_n"] == min(r["n"] for r in rows)
    assert fl["floor_name"] == min(r["name"] for r in rows if r["n"] == fl["floor_n"])


def test_delta_messages(spark):
    log = spark.createDataFrame(
        [("b", 1, "arrival", T0, 1), ("a", 2, "arrival", T0, 1), ("a", 3, "arrival", T0 + dt.timedelta(seconds=0.5), 2)],
        "name string, event_id long, kind string, change_ts timestamp, n long",
    )
    msg = board.delta_messages(board.coalesce_deltas(log, 1)).first()
    assert msg["message"] == '[{"name":"a","count":2},{"name":"b","count":1}]'
    assert msg["entries"] == 2 and msg["part"] == 0


def test_delta_messages_split_into_parts(spark):
    """A bucket with more names than a part holds: every change kept, parts
    name-contiguous and bounded."""
    deltas = spark.createDataFrame(
        [(T0, f"n{i:02d}", i) for i in range(7)], "bucket timestamp, name string, count long"
    )
    rows = board.delta_messages(deltas, max_entries=3).orderBy("part").collect()
    assert [(r["part"], r["entries"]) for r in rows] == [(0, 3), (1, 3), (2, 1)]
    assert rows[1]["message"].startswith('[{"name":"n03","count":3}')


def test_zero_counts_are_not_live(spark):
    m = _mentions(spark, [(0, "gone", T0), (1, "here", T0 + dt.timedelta(minutes=70)), (2, "edge", T0 + dt.timedelta(minutes=10))])
    as_of = T0 + dt.timedelta(minutes=70)
    log = trailing.trailing_changelog(m)
    last = {r["name"]: r["n"] for r in board.last_counts(log, F.lit(as_of)).collect()}
    assert last == {"gone": 0, "edge": 0, "here": 1}
    live = {r["name"]: r["n"] for r in board.latest_per_name(log, F.lit(as_of)).collect()}
    assert live == {"here": 1} == {r["name"]: r["n"] for r in trailing.live_counts(m, as_of).collect()}


TOPS = "bucket int, name string, n long"


def _board_after(spark, out, batches, size):
    """Feed buckets' highest counts to the sink; the board after each."""
    write = stream_board.board_sink(size)(out)
    seen = []
    for b, rows in enumerate(batches):
        write(spark.createDataFrame(rows, TOPS), b)
        now = spark.read.schema(stream_board.BOARD_SCHEMA).parquet(f"{out}/board/slot={b % stream_board.SLOTS}")
        assert {r["batch"] for r in now.collect()} <= {b}
        seen.append([(r["name"], r["n"]) for r in now.orderBy("rank").collect()])
    return seen


def test_name_off_the_board_comes_back(spark, tmp_dir):
    """Size 1: A=5 and B=4 in another bucket, then A expires: B is on the board
    again, though its bucket was not in the batch."""
    none = (0, None, 0)
    boards = _board_after(
        spark, tmp_dir, [[(0, "A", 5), (1, "B", 4)], [none], [], [(0, "C", 4)], [none, (1, None, 0)]], 1
    )
    assert boards == [[("A", 5)], [("B", 4)], [("B", 4)], [("B", 4)], []]
    deltas = stream_board.delta_steps(spark, tmp_dir)
    got = sorted((r["step"], r["name"], r["count"]) for r in deltas.collect())
    assert got == [(1, "A", 5), (2, "A", 0), (2, "B", 4), (3, "B", 0)]
    again = [(r["step"], r["rank"], r["name"], r["n"]) for r in stream_board.boards_from_deltas(deltas).collect()]
    assert sorted(again) == [(1, 1, "A", 5), (2, 1, "B", 4)]


def test_repeated_batch_gives_the_same_board(spark, tmp_dir):
    batches = [[(0, "A", 3), (1, "B", 2)], [(0, "A", 1)], [(2, "C", 9)], [(0, "A", 7)]]
    boards = _board_after(spark, tmp_dir, batches, 2)
    assert boards[-1] == [("C", 9), ("A", 7)]
    stream_board.board_sink(2)(tmp_dir)(spark.createDataFrame([(0, "A", 7)], TOPS), 3)
    now = spark.read.schema(stream_board.BOARD_SCHEMA).parquet(f"{tmp_dir}/board/slot=0")
    assert [(r["name"], r["n"]) for r in now.orderBy("rank").collect()] == boards[-1]


def test_reserve_holds_the_highest():
    """Random changes of 300 names against sorting all of them; all names are
    read again only after many have fallen."""
    import random

    r = random.Random(5)
    size, counts, refills, stored = 10, {}, 0, None
    for k in range(400):
        reserve = stream_trailing.Reserve(size, stored)
        if k % 10 == 9:  # most of the highest fall at once
            for name, _ in reserve.top()[: size - 1]:
                counts[name] = 1
                reserve.put(name, 1)
        for _ in range(r.randrange(1, 20)):
            name, n = f"n{r.randrange(300)}", r.choice([0, 0, 1, 2, 3, r.randrange(40)])
            counts[name] = n
            reserve.put(name, n)

        def all_names():
            nonlocal refills
            refills += 1
            return iter([(k, v) for k, v in counts.items() if v])

        reserve.settle(all_names)
        want = sorted(((-n, name) for name, n in counts.items() if n))[:size]
        assert reserve.top() == [(name, -n) for n, name in want]
        assert len(reserve.held) <= 4 * size
        stored = reserve.stored()
    assert 0 < refills < 200


def _stream_rows(spark, events, order_col="event_id", heartbeat="ts", restarts=False):
    out = runner.replay_runs(
        spark, events, lambda src: stream_trailing.trailing_stream(fixtures.mentions(src), row_buckets=8, name_buckets=4),
        order_col=order_col, sink=stream_trailing.changelog_sink, tag="t", heartbeat=heartbeat, restarts=restarts,
    )
    key = lambda r: (r["name"], r["event_id"], r["kind"], r["change_ts"], r["n"])
    return sorted(map(key, runner.read_sink(spark, out).collect())), key


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


class _Held(dict):
    """A map variable and its handle in memory."""

    def getMapState(self, name, *_):
        return self.setdefault(name, _Held())

    def iterator(self):
        return iter(self.items())

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def registerTimer(self, at):
        pass


class _Value:
    """A value variable in memory."""

    stored = None

    def get(self):
        return self.stored

    def update(self, value):
        self.stored = value


def test_held_mentions_are_stored_small():
    """For a board a mention of some 25 bytes takes a few in the state, without its id."""
    import numpy as np
    import pandas as pd

    at = np.arange(40_000, dtype=np.int64)
    rows = pd.DataFrame({"name": [f"name_{i * 7919 % 300}" for i in at], "ts_us": at // 20 * 1_000_000})
    held = stream_trailing.HeldMentions(60, False)
    state = _Held()
    held.init(state)
    list(held.handleInputRows((0,), iter([rows[:30_000], rows[30_000:]]), None))
    assert sum(len(v[0]) for v in state["data"].values()) < 6 * len(rows)
    back = pd.concat([held._read(c) for (c,) in sorted(state["data"])])
    assert set(back.columns) == {"name", "ts_us", "n"} and back["n"].sum() == len(rows)


def test_state_partitions_follow_the_cores(spark, tmp_dir):
    """With many shuffle partitions the stores of an operator are as many as the cores ask
    for, and the session's number is as before."""
    import os

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "150")
    try:
        runner.replay_runs(
            spark, _events(spark, [(i, i, T0 + dt.timedelta(minutes=i)) for i in range(9)]),
            lambda src: src.groupBy("user_id").count(), runs=1, output_mode="update", tag="parts", checkpoint=tmp_dir,
        )
        assert spark.conf.get(key) == "150"
    finally:
        spark.conf.set(key, before)
    stores = [p for p in os.listdir(f"{tmp_dir}/state/0") if p.isdigit()]
    assert len(stores) == max(runner.STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism) < 150


def test_late_rows_count_as_in_the_batch(spark):
    """Arrivals 0:00, 1:05, 0:59, 1:06 of one name, landed in that order in
    four runs: counts 1, 1, 2, 3 by time, as in the batch changelog."""
    rows = [(i, 1, T0 + dt.timedelta(minutes=m)) for i, m in enumerate((0, 65, 59, 66))]
    got, key = _stream_rows(spark, _events(spark, rows))
    want = sorted(map(key, trailing.trailing_changelog(fixtures.mentions(_events(spark, rows))).collect()))
    assert got == want
    by_id = {(r[1], r[2]): r[4] for r in got}
    assert [by_id[i, "arrival"] for i in range(4)] == [1, 2, 2, 3]


def test_stream_holds_back_what_may_still_change(spark):
    """Without a heartbeat the log ends at the watermark: the newest time
    less 10 minutes."""
    rows = [(i, i % 2, T0 + dt.timedelta(minutes=7 * i)) for i in range(20)]
    got, key = _stream_rows(spark, _events(spark, rows), heartbeat=None)
    mark = T0 + dt.timedelta(minutes=7 * 19 - 10)
    log = trailing.trailing_changelog(fixtures.mentions(_events(spark, rows))).collect()
    assert got == sorted(key(r) for r in log if r["change_ts"] <= mark)


def test_pipeline_tee_and_board(spark, tmp_dir):
    """Records through the two-query application: the mentions tee holds
    every parsed name once, the board holds the top names after the run."""
    import os

    from tallyho.operators import replay
    from tallyho.sources import feed
    from tallyho.streaming import pipeline

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    cols = [""] * 27
    with open(os.path.join(src, "20150218100000.gkg.csv"), "w") as fh:
        for i, names in enumerate(["Ann,1;Bob,5", "Ann,2", "Cy,3;Ann,9;null,1"], start=1):
            cols[0], cols[1], cols[23] = f"20150218100000-{i}", "20150218100000", names
            fh.write("\t".join(cols) + "\n")
    topic = os.path.join(tmp_dir, "topic")
    for _ in range(2):  # a segment that is offered again is published once
        pipeline.publish(replay.feed_records(feed.read_lines(spark, src)), topic)
    assert spark.read.parquet(topic).count() == 3
    # a heartbeat: a record without names moves the watermark past the others
    beat = spark.createDataFrame(
        [("20150220100000-1", "x", dt.datetime(2015, 2, 18, 10, 40))], "key string, value string, timestamp timestamp"
    )
    cols[0], cols[1], cols[23] = "20150218103000-1", "20150218103000", "Dee,1"
    beat = beat.withColumn("value", F.lit("\t".join(cols)))
    pipeline.publish(beat, topic)
    root = os.path.join(tmp_dir, "app")
    qs = pipeline.start(spark, pipeline.records_source(spark, topic), root, board_size=2, available_now=True)
    for q in qs.values():
        q.awaitTermination()
        assert q.exception() is None
    names = sorted(r["name"] for r in spark.read.parquet(f"{root}/mentions").collect())
    assert names == ["Ann", "Ann", "Ann", "Bob", "Cy", "Dee"]
    boards = spark.read.schema(stream_board.BOARD_SCHEMA).parquet(f"{root}/board/board")
    last = boards.agg(F.max("batch")).first()[0]
    top = [(r["name"], r["n"]) for r in boards.where(F.col("batch") == last).orderBy("rank").collect()]
    assert top == [("Ann", 3), ("Bob", 1)]
    # The counter reads what the tee has committed; a run with nothing new changes nothing.
    assert "/mentions" in qs["counter"].lastProgress["sources"][0]["description"]
    again = pipeline.start(spark, pipeline.records_source(spark, topic), root, board_size=2, available_now=True)
    again["counter"].awaitTermination()
    assert pipeline.read_mentions(spark, root).count() == 6
    assert [(r["name"], r["n"]) for r in pipeline.newest_board(spark, root).orderBy("rank").collect()] == top


def test_stored_mentions_have_their_ids_when_read(spark, tmp_dir):
    """The mentions topic holds positions, which compress, and gives the ids of the parse."""
    from tallyho.sources import feed
    from tallyho.streaming import pipeline

    value = "\t".join(["20150218100000-1", "20150218100000"] + [""] * 21 + ["Ann,1;null,2;Ann,3", "", "", ""])
    records = spark.createDataFrame([("20150218100000-1", value, T0)], "key string, value string, timestamp timestamp")
    pipeline.publish(records, f"{tmp_dir}/topic")
    source = pipeline.records_source(spark, f"{tmp_dir}/topic")
    for q in pipeline.start(spark, source, f"{tmp_dir}/app", board_size=2, available_now=True).values():
        q.awaitTermination()
    assert "event_id" not in spark.read.parquet(f"{tmp_dir}/app/mentions").columns
    got = pipeline.read_mentions(spark, f"{tmp_dir}/app")
    want = feed.record_mentions(records)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and want.count() == 2


def test_mentions_of_a_time_are_packed():
    """One row for the names of a time, whatever they hold; nulls leave no name, and a record's
    500 names take a few bytes each."""
    import numpy as np
    import pyarrow as pa

    at = pa.array([7, 5, 7, 5, 9, None], pa.timestamp("us", tz="UTC"))
    batch = pa.record_batch([at, pa.array(["é;", "", "é;", None, None, "lost"])], names=["ts", "name"])
    (out,) = stream_trailing._packed_by_time(iter([batch, batch.slice(0, 1)]))
    got = {}
    for us, packed in zip(out["ts"].cast(pa.int64()).to_pylist(), out["packed"].to_pylist(), strict=True):
        names, (n,) = stream_trailing._unpack(packed, 1)
        got[us] = dict(zip(names.to_pylist(), n.tolist(), strict=True))
    assert got == {5: {"": 1}, 7: {"é;": 3}, 9: {}}
    names = pa.array([f"name_{i * 7919 % 300}" for i in range(500)])
    ts = pa.array(np.full(500, 10**15), pa.timestamp("us", tz="UTC"))
    (row,) = stream_trailing._packed_by_time(iter([pa.record_batch([ts, names], names=["ts", "name"])]))
    assert row.num_rows == 1 and len(row["packed"][0].as_py()) < 4 * 500


def test_packed_mentions_give_the_same_boards(spark, monkeypatch):
    """Twelve mentions at each time, in rows of a few and chunks of fewer: boards and deltas
    are those of mentions that come one by one."""
    monkeypatch.setattr(stream_trailing, "PACK_ROWS", 9)
    monkeypatch.setattr(stream_trailing, "CHUNK_ROWS", 7)
    monkeypatch.setattr(stream_trailing, "HELD_ROWS", 11)
    rows = [(i, i * 31 % (7 + i // 100), T0 + dt.timedelta(minutes=i // 12 * 3)) for i in range(480)]
    steps = []
    for packed in (False, True):
        out = runner.replay_runs(
            spark, _events(spark, rows),
            lambda src, p=packed: stream_trailing.board_stream(fixtures.mentions(src), 3, row_buckets=4, name_buckets=2, packed=p),
            runs=3, sink=stream_board.board_sink(3), tag="packed", heartbeat="ts", restarts=True,
        )
        steps.append(sorted(map(tuple, stream_board.delta_steps(spark, out).collect())))
    assert steps[0] == steps[1] and len({s for s, _, _ in steps[0]}) == 4


def test_shuffled_mentions_of_records_are_small(spark, tmp_dir):
    """The counter packs the mentions of a record before it shuffles them."""
    from tallyho.streaming import pipeline

    names = ";".join(f"name_{i * 7919 % 300},{i}" for i in range(600))
    values = ["\t".join([f"20150218100000-{k}", "20150218100000"] + [""] * 21 + [names, "", "", ""]) for k in range(20)]
    records = [(v.split("\t")[0], v, T0 + dt.timedelta(seconds=40 * k)) for k, v in enumerate(values)]
    pipeline.publish(spark.createDataFrame(records, "key string, value string, timestamp timestamp"), f"{tmp_dir}/topic")
    queries = pipeline.start(spark, pipeline.records_source(spark, f"{tmp_dir}/topic"), f"{tmp_dir}/app", board_size=2, available_now=True)
    queries["counter"].awaitTermination()
    assert pipeline.read_mentions(spark, f"{tmp_dir}/app").count() == 20 * 600
    plan = queries["counter"]._jsq.explainInternal(False)
    assert plan.index("TransformWithState") < plan.index("Exchange") < plan.rindex("MapInArrow")


def test_board_counts_lie_in_pages(monkeypatch):
    """Many names of a bucket take few state calls, and their counts rise, fall and leave."""
    import random

    import pandas as pd

    monkeypatch.setattr(stream_trailing, "NAME_PAGES", 4)
    calls = []
    state = _Held()
    state.getMapState("pages").getValue = lambda key: calls.append(key) or dict.get(state["pages"], key)
    monkeypatch.setattr(_Held, "getValueState", lambda self, name, _: _Value(), raising=False)
    counts = stream_trailing.NameCounts(5)
    counts.init(state)
    r, want = random.Random(3), {}
    for _ in range(6):
        changes = [(f"näme {r.randrange(200)}", r.randrange(4)) for _ in range(300)]
        changes += [(name, -n) for name, n in want.items() if r.random() < 0.3]
        for name, n in changes:
            want[name] = want.get(name, 0) + n
        rows = pd.DataFrame(changes, columns=["name", "n"]).assign(change_us=0)
        out = list(counts.handleInputRows((0,), iter([rows]), None))
        top = sorted(((-n, name) for name, n in want.items() if n))[:5]
        assert not out or [(n, name) for name, n in zip(out[-1]["name"], -out[-1]["n"], strict=True)] == top
    held = {}
    for (counts_of,) in state["pages"].values():
        held |= json.loads(counts_of)
    assert held == {name: n for name, n in want.items() if n} and len(calls) <= 6 * 4


def test_stores_take_no_disk_ahead(spark):
    runner.stream_conf(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"


def test_stream_busy_name_chunks(spark):
    """One name with a mention every 7 minutes for 9 hours, another every 50,
    up to 9 minutes late within and across four landings: stored chunks arrive
    and expire in part and in whole, and the log equals the batch changelog."""
    timed = [(5, T0 + dt.timedelta(minutes=7 * i)) for i in range(78)]
    timed += [(6, T0 + dt.timedelta(minutes=50 * i, seconds=30)) for i in range(11)]
    rows = [(i, u, t) for i, (u, t) in enumerate(sorted(timed, key=lambda r: r[1]))]
    late = F.pmod(F.col("event_id") * 7919, F.lit(540)) * 1_000_000
    events = _events(spark, rows).withColumn("arrival_us", F.unix_micros(F.col("ts").cast("timestamp")) + late)
    got, key = _stream_rows(spark, events, order_col="arrival_us")
    want = sorted(map(key, trailing.trailing_changelog(fixtures.mentions(events)).collect()))
    assert got == want
    # with a mention every 7 minutes the trailing hour holds 9 of them
    assert max(r[4] for r in got if r[0] == "user_5") == 9


def test_hot_name_is_split(spark, tmp_dir, monkeypatch):
    """One name with two thirds of the rows, many at one time: its mentions lie in
    every bucket, in chunks of a few rows, its running sum is cut into pieces, and
    the log equals the batch changelog."""
    monkeypatch.setattr(stream_trailing, "CHUNK_ROWS", 7)
    rows = [(i, 1 if i % 3 else i, T0 + dt.timedelta(minutes=(i * 7) // 40 * 3)) for i in range(600)]
    kept = {}
    real = stream_trailing.changelog

    def seen(batch, pieces):
        for r in batch.where("kind = 'arrival' and name = 'user_1'").select("bucket").distinct().collect():
            kept.setdefault("buckets", set()).add(r["bucket"])
        out = real(batch, pieces)
        hot = spark.read.parquet(pieces).where("name = 'user_1'").select("_piece").distinct().count()
        kept["pieces"] = max(kept.get("pieces", 0), hot)
        return out

    monkeypatch.setattr(stream_trailing, "changelog", seen)
    got, key = _stream_rows(spark, _events(spark, rows), restarts=True)
    want = sorted(map(key, trailing.trailing_changelog(fixtures.mentions(_events(spark, rows))).collect()))
    assert got == want
    assert len(kept["buckets"]) == 8 and kept["pieces"] > 2


def test_stored_counts_are_those_at_the_watermark(spark, tmp_dir):
    """The state as a table, after a run and after one that goes on from it."""
    import os

    from tallyho.streaming import stored

    rows = [(i, i % 5, T0 + dt.timedelta(minutes=4 * i)) for i in range(60)]
    checkpoint = os.path.join(tmp_dir, "checkpoint")
    runner.replay_runs(
        spark, _events(spark, rows), lambda src: stream_trailing.trailing_stream(fixtures.mentions(src), row_buckets=4, name_buckets=4),
        sink=stream_trailing.changelog_sink, runs=2, tag="st", restarts=True, checkpoint=checkpoint,
    )
    assert {"counts", "data", "meta"} <= set(stored.state_variables(spark, checkpoint))
    mark = T0 + dt.timedelta(minutes=4 * 59 - 10)
    want = {}
    for _, u, t in rows:
        if mark - dt.timedelta(hours=1) < t <= mark:
            want[f"user_{u}"] = want.get(f"user_{u}", 0) + 1
    assert {r["name"]: r["n"] for r in stored.stored_counts(spark, checkpoint).collect()} == want


def test_flush_on_the_stream(spark):
    """Rows out of order at fractions of seconds, watermarks in the middle of a second:
    each time's changes come in one batch, and equal those of the batch changelog."""
    rows = [
        (i, i % 3, T0 + dt.timedelta(milliseconds=137 * i - 900 * (i % 4), microseconds=i)) for i in range(400)
    ]
    rows += [(1000 + i, i % 3, T0 + dt.timedelta(minutes=60, milliseconds=91 * i)) for i in range(300)]
    events = _events(spark, rows)
    want = board.coalesce_deltas(trailing.trailing_changelog(fixtures.mentions(events)), 2)
    for restarts in (False, True):
        out = runner.replay_runs(
            spark,
            events,
            lambda src: stream_trailing.flush_stream(fixtures.mentions(src), 2, watermark="4 seconds", row_buckets=4, name_buckets=2),
            runs=5,
            tag="flush-test",
            heartbeat="ts",
            restarts=restarts,
        )
        got = runner.read_sink(spark, out)
        assert sorted(map(tuple, got.select("bucket", "name", "count").collect())) == sorted(map(tuple, want.collect()))
        assert got.select("batch").distinct().count() > 2
        assert got.groupBy("bucket").agg(F.countDistinct("batch").alias("n")).where("n > 1").isEmpty()


def test_repeated_flush_sends_the_same(spark, tmp_dir):
    sink = stream_board.flush_sink(tmp_dir)
    rows = spark.createDataFrame([(T0, "b", 1), (T0, "a", 0)], "bucket timestamp, name string, count long")
    for number, batch in ((1, rows), (1, rows), (2, rows.limit(0))):
        sink(batch, number)
    (message,) = runner.read_sink(spark, tmp_dir).collect()
    assert message["message"] == '[{"name":"a","count":0},{"name":"b","count":1}]' and message["entries"] == 2


def test_landed_rows_are_spread_over_files(spark):
    """A slice that one task wrote is read by many: its files hold equal shares, none is lost."""
    rows = spark.range(4000).withColumn("line", F.concat(F.lit("x"), "id")).coalesce(1)
    out = runner.replay_runs(
        spark, rows, lambda src: src.select("id", F.input_file_name().alias("file")), order_col="id", runs=1, tag="spread", spread=True
    )
    got = runner.read_sink(spark, out)
    assert got.select("id").distinct().count() == got.count() == 4000
    sizes = [r["count"] for r in got.groupBy("file").count().collect()]
    assert len(sizes) == 4 * spark.sparkContext.defaultParallelism and max(sizes) < 2 * 4000 / len(sizes)


def test_windows_need_no_second_shuffle(spark):
    from tallyho.streaming import sliding

    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    updates = spark.createDataFrame([(minutes(0), "a", 1), (minutes(0), "a", 3), (minutes(15), "a", 2)], "slot_start timestamp, name string, n long")
    windows = sliding.window_counts(sliding.final_counts(updates), 60, 15)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
    assert sorted((r["window_start"], r["n"]) for r in windows.collect()) == [
        (minutes(m), n) for m, n in ((-45, 3), (-30, 5), (-15, 5), (0, 5), (15, 2))
    ]


def test_rows_without_order_value_are_landed(spark):
    rows = [(i if i % 4 else None, 1, T0 + dt.timedelta(minutes=i)) for i in range(12)]
    events = _events(spark, rows)
    out = runner.replay_runs(spark, events, lambda src: src.select("user_id", "ts"), tag="nulls")
    assert runner.read_sink(spark, out).count() == 12


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 300)), min_size=1, max_size=60))
def test_changelog_property(spark, items):
    """Random mentions (many at equal times): each arrival counts the
    mentions in (t - 1 h, t] up to itself, no count is negative, and every
    name ends at 0 after its last expiry."""
    rows = [(i, name, T0 + dt.timedelta(minutes=m)) for i, (name, m) in enumerate(items)]
    log = trailing.trailing_changelog(_mentions(spark, rows)).collect()
    hour = dt.timedelta(hours=1)
    for r in log:
        assert r["n"] >= 0
        if r["kind"] != "arrival":
            continue
        t, me = r["change_ts"], r["event_id"]
        came = sum(1 for i, n, ts in rows if n == r["name"] and (ts < t or (ts == t and i <= me)))
        left = sum(1 for i, n, ts in rows if n == r["name"] and ts + hour <= t)
        assert r["n"] == came - left
    last = {}
    for r in sorted(log, key=lambda r: (r["change_ts"], r["kind"] == "arrival", r["event_id"])):
        last[r["name"]] = r["n"]
    assert set(last.values()) == {0}
