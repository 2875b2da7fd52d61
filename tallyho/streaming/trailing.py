"""Trailing count per name on a stream (R2 keyed running count, R3 timed
decrement, R5 changelog output), in two chained stateful operators
(``transformWithStateInPandas``) whose work is spread whatever the names are.

1. :class:`HeldMentions` is keyed by a hash of the row, not by the name. It holds a
   mention until the watermark has passed it, and then until its expiry, and
   hands on both steps (+1, -1) when they are due, with each name's sum. Rows of
   a hot name lie in all buckets.
2. :class:`NameCounts` is keyed by a hash of the name and gets the sums alone, one
   for each name and bucket: it keeps the count of every live name. It hands on the
   count before the steps of this batch, or the bucket's highest counts (the board).
   The steps themselves pass it by, keyed by the bucket that they come from.

For a flush every second (:func:`flush_stream`) the first operator holds steps until the
watermark has passed their second, and hands on one sum for each name and second; the second
one gives each name's count at the end of each second in which it changed. So a second is in
one batch, and a name costs rows for its seconds, not its mentions.

The changelog is put together in ``foreachBatch`` (:func:`changelog_sink`): a
running sum of a batch's steps per name, cut into pieces, so a hot name is split
there too, from the name's count before the batch.

No row can come any more once the watermark has passed it, and steps are counted in the
order of (time, expiry before arrival, event id): the output is the batch changelog
:func:`tallyho.operators.trailing.trailing_changelog`, row by row, in whatever
order the rows arrived within the watermark's delay. Rows later than that are
dropped by Spark before they reach the state.

State. A bucket's mentions are stored on RocksDB in compressed chunks (``data``), with an
index of the chunks (``meta``). Where no steps are handed on (board, flush), they are stored
without ids, as a number for each name and time. Where many mentions have one time (those of
a record), they also come so (:func:`by_time`): a row for each time, whose names are packed before
the shuffle, and the bucket is a hash of that row. A batch adds its rows as chunks of ``CHUNK_ROWS`` at most, each
a range of due times, and when the watermark moves only chunks with something due are
read. A bucket takes rows in, and works through its chunks, ``HELD_ROWS`` at a time. It has one
event-time timer, at its oldest due time. Counts are a map by name (``counts``); a name
whose count is 0 has no entry. For a board they lie in ``NAME_PAGES`` pages of a bucket (``pages``),
each with the counts of the names of one hash, so a batch that changes many names reads and
writes pages, not single names. Rows without a name only move the watermark (a
heartbeat). The numbers of buckets and pages are fixed for the life of a checkpoint: take some buckets
for each core of the cluster.
"""

from __future__ import annotations

import heapq
import json
import struct
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from ..operators.running import running_sum
from ..operators.trailing import ARRIVAL, EXPIRY, RETENTION_MINUTES

# The processors run in Python workers (and in a driver-side runner that
# reads their state schemas), which need not have this package installed: the
# classes travel by value, constants included.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_BUCKETS = 32
NAME_BUCKETS = 32
NAME_PAGES = 1024
#: Mentions in one stored chunk, that a bucket holds in memory, and that are packed at once.
CHUNK_ROWS = 16_384
HELD_ROWS = 1 << 20
PACK_ROWS = 1 << 16
SUM, BASE, TOP, FLUSH = "sum", "base", "top", "flush"
STEP_SCHEMA = "bucket int, kind string, name string, event_id long, change_us long, n long"
META_SCHEMA = "arrived boolean, oldest_us long"
CHANGELOG_SCHEMA = "name string, event_id long, kind string, change_ts timestamp, n long"
_MINUTE_US = 60_000_000
_SLOTS = 3
_HEAD = "<QQ"


def _pack(names: pa.StringArray, *numbers: np.ndarray) -> bytes:
    """Names and numbers of as many rows. Lengths and numbers go byte by byte (all first
    bytes, all second ones): the upper ones are mostly 0."""
    offsets, text = np.zeros(1, np.int32), b""
    if len(names):
        offsets = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1]
        text = names.buffers()[2][int(offsets[0]) : int(offsets[-1])] if offsets[-1] > offsets[0] else b""
    columns = [np.ascontiguousarray(x, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for x in (*numbers, np.diff(offsets))]
    raw = b"".join([*columns, text])
    return struct.pack(_HEAD, len(names), len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes, n_numbers: int) -> tuple[pa.StringArray, list[np.ndarray]]:
    """What :func:`_pack` has put together."""
    rows, size = struct.unpack_from(_HEAD, packed)
    raw = pa.decompress(packed[struct.calcsize(_HEAD) :], decompressed_size=size, codec="zstd")
    column = lambda i: np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * rows, 8 * rows * i).reshape(8, rows).T).view(np.int64).ravel()
    offsets = np.zeros(rows + 1, np.int32)
    np.cumsum(column(n_numbers), out=offsets[1:])
    names = pa.StringArray.from_buffers(rows, pa.py_buffer(offsets), raw.slice(8 * rows * (n_numbers + 1)))
    return names, [column(i) for i in range(n_numbers)]


def _packed_by_time(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ts, name) -> (ts, packed): the names of a time, and the number of each, in one row for
    each ``PACK_ROWS`` mentions or so. A time without names has a row too."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.filter(pc.is_valid(table["ts"]))
        times, at = np.unique(table["ts"].combine_chunks().cast(pa.int64()).to_numpy(), return_inverse=True)
        words = table["name"].combine_chunks().cast(pa.string()).dictionary_encode()
        named = words.indices.is_valid().to_numpy(zero_copy_only=False)
        order = pc.sort_indices(words.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pairs, n = np.unique(at[named] * len(order) + rank[words.indices.drop_null().to_numpy()], return_counts=True)
        names = words.dictionary.take(pa.array(order[pairs % max(len(order), 1)]))
        ends = np.searchsorted(pairs, np.arange(len(times) + 1) * len(order))
        packs = [_pack(names[a:b], n[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(times, pa.int64()).cast(table["ts"].type), pa.array(packs, pa.binary())], names=["ts", "packed"])

    yield from map(flush, _runs(batches, PACK_ROWS))


def by_time(mentions: DataFrame) -> DataFrame:
    """Mentions (name, ts) of a stream -> (ts, packed), some for each time."""
    return mentions.select("ts", "name").mapInArrow(_packed_by_time, "ts timestamp, packed binary")


class HeldMentions(StatefulProcessor):
    """The steps of mentions once they are due, from any number of names."""

    def __init__(self, retention_minutes: int, with_steps: bool, every_us: int | None = None):
        self.retention_us = int(retention_minutes) * _MINUTE_US
        self.with_steps = with_steps
        self.columns = ["name", "event_id", "ts_us"] if with_steps else ["name", "ts_us", "n"]
        self.every_us = every_us  # steps are due when so long a time is over as a whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getMapState("meta", "chunk long", META_SCHEMA)
        self.data = handle.getMapState("data", "chunk long", "rows binary")

    # -- state helpers -----------------------------------------------------

    def _index(self) -> dict[int, tuple[bool, int]]:
        """chunk -> (arrived, oldest due time in us)."""
        return {int(k[0]): (bool(v[0]), int(v[1])) for k, v in self.meta.iterator()}

    def _read(self, chunk: int) -> pd.DataFrame:
        stored = self.data.getValue((chunk,))[0]
        if not self.with_steps:
            names, (ts_us, n) = _unpack(stored, 2)
            return pd.DataFrame({"name": names.to_pandas(), "ts_us": ts_us, "n": n})
        with pa.ipc.open_stream(stored) as rows:
            return rows.read_pandas()

    def _write(self, index: dict, chunk: int, arrived: bool, rows: pd.DataFrame) -> None:
        """Store a chunk and its index entry, or drop both when it is empty."""
        if rows.empty:
            if index.pop(chunk, None):
                self.meta.removeKey((chunk,))
                self.data.removeKey((chunk,))
            return
        if self.with_steps:
            table = pa.Table.from_pandas(rows, preserve_index=False)
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            stored = out.getvalue().to_pybytes()
        else:
            stored = _pack(pa.array(rows["name"], pa.string()), rows["ts_us"], rows["n"])
        index[chunk] = (arrived, int(rows["ts_us"].min()) + (self.retention_us if arrived else 0))
        self.meta.updateValue((chunk,), index[chunk])
        self.data.updateValue((chunk,), (stored,))

    def _add(self, index: dict, arrived: bool, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("ts_us", kind="stable", ignore_index=True)
        for at in range(0, len(rows), CHUNK_ROWS):
            self._write(index, max(index, default=-1) + 1, arrived, rows[at : at + CHUNK_ROWS])

    def _take(self, index: dict, until_us: int) -> Iterator[tuple[bool, pd.DataFrame]]:
        """Remove and return the mentions that are due at or before ``until_us``, chunk by
        chunk, with whether they had arrived."""
        for chunk, (arrived, due_us) in list(index.items()):
            if due_us <= until_us:
                rows = self._read(chunk)
                due = rows["ts_us"] + (self.retention_us if arrived else 0) <= until_us
                self._write(index, chunk, arrived, rows[~due])
                yield arrived, rows[due]

    def _fires(self, index: dict) -> int | None:
        """When something is due next, in ms (rounded up)."""
        if not index:
            return None
        due = min(due for _, due in index.values())
        if self.every_us:
            due = (due // self.every_us + 1) * self.every_us
        return -(-due // 1000)

    def _move_timer(self, old: int | None, index: dict) -> None:
        """The one timer of a bucket: at its oldest due time."""
        new = self._fires(index)
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)

    # -- handlers ----------------------------------------------------------

    def _given(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The columns to hold, of rows as they come."""
        if "packed" in rows.columns:
            for part in _runs(((ts_us, *_unpack(packed, 1)) for ts_us, packed in zip(rows["ts_us"], rows["packed"], strict=True)), CHUNK_ROWS, 1):
                names = pa.concat_arrays([names for _, names, _ in part])
                times = np.repeat([ts_us for ts_us, _, _ in part], [len(names) for _, names, _ in part])
                yield pd.DataFrame({"name": names.to_pandas(), "ts_us": times, "n": np.concatenate([n for _, _, (n,) in part])})
            return
        given = [c for c in self.columns if c != "n"]
        new = rows.loc[rows["name"].notna(), given]
        yield new if self.with_steps else new.groupby(given, as_index=False, sort=False).size().rename(columns={"size": "n"})

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        index = self._index()
        old = self._fires(index)
        for new in _runs((part for r in rows for part in self._given(r)), HELD_ROWS):
            self._add(index, False, pd.concat(new, ignore_index=True))
        if self._fires(index) != old:
            self._move_timer(old, index)
        return iter(())

    def handleExpiredTimer(
        self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        index = self._index()
        until = int(timerValues.getCurrentWatermarkInMs()) * 1000
        if self.every_us:
            until = until // self.every_us * self.every_us - 1
        sums: list[pd.DataFrame] = []

        def steps(arrived: bool, due: pd.DataFrame) -> pd.DataFrame:
            """The steps of a chunk's mentions, whose sums are kept."""
            # of those that had not arrived, some arrive and expire before this watermark
            gone = due if arrived else due[due["ts_us"] + self.retention_us <= until]
            new = due[:0] if arrived else due
            if not self.with_steps and not self.every_us and not arrived:
                new, gone = due.drop(gone.index), due[:0]  # they don't count at the watermark
            if not self.with_steps:
                new, gone = new.assign(change_us=new["ts_us"]), gone.assign(change_us=gone["ts_us"] + self.retention_us, n=-gone["n"])
            else:
                new = new.assign(kind=ARRIVAL, change_us=new["ts_us"], n=1)
                gone = gone.assign(kind=EXPIRY, change_us=gone["ts_us"] + self.retention_us, n=-1)
            out = pd.concat([new, gone], ignore_index=True)
            if len(out):
                of = out.assign(change_us=out["change_us"] // self.every_us * self.every_us if self.every_us else 0)
                sums.append(of.groupby(["name", "change_us"], as_index=False)["n"].sum())
                if len(sums) > 64:
                    sums[:] = [_summed(sums)]
            return out

        stay: list[pd.DataFrame] = []
        n_stay = 0
        for arrived, due in self._take(index, until):
            if not arrived:
                stay.append(due[due["ts_us"] + self.retention_us > until])
                n_stay += len(stay[-1])
                if n_stay >= HELD_ROWS:
                    self._add(index, True, pd.concat(stay, ignore_index=True))
                    stay, n_stay = [], 0
            out = steps(arrived, due)
            if self.with_steps and len(out):
                yield self._rows(key, out)
        if stay:
            self._add(index, True, pd.concat(stay, ignore_index=True))
        self._move_timer(None, index)  # the timer that fired is gone
        if sums:
            total = _summed(sums)
            if not self.with_steps and not self.every_us:
                total = total[total["n"] != 0]
            yield self._rows(key, total.assign(kind=SUM, event_id=0))

    def _rows(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(bucket=key[0])[["bucket", "kind", "name", "event_id", "change_us", "n"]]

    def close(self) -> None:
        pass


def _runs(parts: Iterator, rows: int, at: int | None = None) -> Iterator[list]:
    """Parts (or tuples with one in place ``at``) in lists of ``rows`` rows or a little more."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part if at is None else part[at])
        if n >= rows:
            yield held
            held, n = [], 0
    if held:
        yield held


def _summed(sums: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(sums, ignore_index=True).groupby(["name", "change_us"], as_index=False)["n"].sum()


class Reserve:
    """The highest counts of a bucket, ordered by count and name, and some more.

    Every name up to ``bound`` in that order is held, so the first ``size`` are right
    as long as so many are held. Names that fall behind the bound leave; when
    fewer than ``size`` are left, the reserve is filled anew from all names of the
    bucket, which takes at least ``size`` such falls.
    """

    def __init__(self, size: int, stored: str | None):
        self.size = size
        held, bound = json.loads(stored) if stored else ([], None)
        self.held: dict[str, int] = dict(held)
        self.bound: tuple | None = tuple(bound) if bound else None  # None: all names are held

    def stored(self) -> str:
        return json.dumps([list(self.held.items()), self.bound])

    def put(self, name: str, n: int) -> None:
        if n > 0 and (self.bound is None or (-n, name) <= self.bound):
            self.held[name] = n
        else:
            self.held.pop(name, None)

    def settle(self, all_names: Callable[[], Iterator[tuple[str, int]]]) -> None:
        """Keep between ``size`` and four times as many names."""
        if len(self.held) > 4 * self.size:
            self._fill(self.held.items(), self.bound)
        elif len(self.held) < self.size and self.bound is not None:
            self._fill(all_names(), None)

    def _fill(self, names, bound: tuple | None) -> None:
        best = heapq.nsmallest(2 * self.size + 1, ((-n, name) for name, n in names))
        if len(best) > 2 * self.size:
            best = best[:-1]
            bound = best[-1]
        self.held, self.bound = {name: -n for n, name in best}, bound

    def top(self) -> list[tuple[str, int]]:
        return [(name, -n) for n, name in heapq.nsmallest(self.size, ((-n, name) for name, n in self.held.items()))]


class NameCounts(StatefulProcessor):
    """Counts of the names of a bucket. Hands on each changed name's count
    before the batch (``board_size`` None), or the bucket's ``board_size`` highest
    counts if they changed, or (``flush``) its count after each time that it changed in.
    Steps (buckets below 0) pass."""

    def __init__(self, board_size: int | None, flush: bool = False):
        self.board_size = board_size
        self.flush = flush

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.board_size is None:
            self.counts = handle.getMapState("counts", "name string", "n long")
        else:
            self.pages = handle.getMapState("pages", "page int", "counts string")
            self.reserve = handle.getValueState("reserve", "stored string")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            for r in rows:
                yield r[["bucket", "kind", "name", "event_id", "change_us", "n"]]
            return
        sums = pd.concat([r[["name", "change_us", "n"]] for r in rows], ignore_index=True)
        changes = sums.groupby("name")["n"].sum()
        names, before, after = list(changes.index), [], []
        if self.board_size is not None:
            yield from self._board(key, self._turned(changes))
            return
        for name, change in changes.items():
            held = self.counts.getValue((name,))
            before.append(int(held[0]) if held else 0)
            after.append(before[-1] + int(change))
            if after[-1]:
                self.counts.updateValue((name,), (after[-1],))
            elif held:
                self.counts.removeKey((name,))
        if self.flush:
            at = sums.groupby(["name", "change_us"], as_index=False)["n"].sum().sort_values(["name", "change_us"], ignore_index=True)
            counts = at["name"].map(dict(zip(names, before, strict=True))) + at.groupby("name")["n"].cumsum()
            yield self._rows(key, FLUSH, list(at["name"]), list(counts), list(at["change_us"]))
        else:
            yield self._rows(key, BASE, names, before)

    def _turned(self, changes: pd.Series) -> Iterator[tuple[str, int]]:
        """The changed names and their counts now, as the pages have them from now on."""
        by_page: dict[int, list[tuple[str, int]]] = {}
        for name, change in changes.items():
            by_page.setdefault(zlib.crc32(name.encode()) % NAME_PAGES, []).append((name, int(change)))
        for page, changed in by_page.items():
            stored = self.pages.getValue((page,))
            counts = json.loads(stored[0]) if stored else {}
            for name, change in changed:
                n = counts.pop(name, 0) + change
                if n:
                    counts[name] = n
                yield name, n
            if counts:
                self.pages.updateValue((page,), (json.dumps(counts, ensure_ascii=False, separators=(",", ":")),))
            elif stored:
                self.pages.removeKey((page,))

    def _board(self, key, changed: Iterator[tuple[str, int]]) -> Iterator[pd.DataFrame]:
        stored = self.reserve.get()
        reserve = Reserve(self.board_size, stored[0] if stored else None)
        before = reserve.top()
        for name, n in changed:
            reserve.put(name, n)
        reserve.settle(lambda: (item for _, page in self.pages.iterator() for item in json.loads(page[0]).items()))
        self.reserve.update((reserve.stored(),))
        top = reserve.top()
        if top != before:
            # A bucket without names says so in a row without a name.
            yield self._rows(key, TOP, *map(list, zip(*(top or [(None, 0)]), strict=True)))

    def _rows(self, key, kind: str, names: list, n: list, change_us: list | int = 0) -> pd.DataFrame:
        return pd.DataFrame({"bucket": key[0], "kind": kind, "name": names, "event_id": 0, "change_us": change_us, "n": n})

    def close(self) -> None:
        pass


def _counted(
    mentions: DataFrame,
    retention_minutes: int,
    watermark: str,
    board_size: int | None,
    row_buckets: int,
    name_buckets: int,
    every_us: int | None = None,
    packed: bool = False,
) -> DataFrame:
    with_steps = board_size is None and every_us is None
    identity = ["event_id", "name", "ts"]
    columns = ["name", "event_id"] if with_steps else ["name"]
    if packed:
        mentions, identity, columns = by_time(mentions), ["ts", "packed"], ["packed"]
    row = F.pmod(F.xxhash64(*identity), F.lit(row_buckets)).cast("int")
    keyed = mentions.withWatermark("ts", watermark).select(
        row.alias("bucket"), *columns, "ts", F.unix_micros("ts").alias("ts_us")
    )
    steps = keyed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=HeldMentions(retention_minutes, with_steps, every_us),
        outputStructType=STEP_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )
    name = F.pmod(F.xxhash64("name"), F.lit(name_buckets)).cast("int")
    to = F.when(F.col("kind") == SUM, name).otherwise(-1 - F.col("bucket"))
    return (
        steps.withColumn("bucket", to)
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=NameCounts(board_size, every_us is not None),
            outputStructType=STEP_SCHEMA,
            outputMode="Append",
            timeMode="None",
        )
    )


def trailing_stream(
    mentions: DataFrame,
    retention_minutes: int = RETENTION_MINUTES,
    watermark: str = "10 minutes",
    row_buckets: int = ROW_BUCKETS,
    name_buckets: int = NAME_BUCKETS,
) -> DataFrame:
    """Streaming mentions (event_id, name, ts) -> each step once the watermark has passed
    it, and each changed name's count before the batch: what
    :func:`changelog_sink` makes the changelog of."""
    return _counted(mentions, retention_minutes, watermark, None, row_buckets, name_buckets)


def board_stream(
    mentions: DataFrame,
    board_size: int,
    retention_minutes: int = RETENTION_MINUTES,
    watermark: str = "10 minutes",
    row_buckets: int = ROW_BUCKETS,
    name_buckets: int = NAME_BUCKETS,
    packed: bool = False,
) -> DataFrame:
    """Streaming mentions (event_id, name, ts) -> (bucket, name, n): the ``board_size``
    highest counts at the watermark, of each bucket of names where they changed
    (one row without a name where none is left). ``packed`` is for mentions of which many
    have one time; they need no event_id."""
    rows = _counted(mentions, retention_minutes, watermark, board_size, row_buckets, name_buckets, packed=packed)
    return rows.select("bucket", "name", "n")


def flush_stream(
    mentions: DataFrame,
    every_seconds: int = 1,
    retention_minutes: int = RETENTION_MINUTES,
    watermark: str = "10 minutes",
    row_buckets: int = ROW_BUCKETS,
    name_buckets: int = NAME_BUCKETS,
) -> DataFrame:
    """Streaming mentions (event_id, name, ts) -> (bucket, name, count): each name's last
    count in each time of ``every_seconds`` in which it changed, once the watermark has
    passed that time; all rows of one ``bucket`` come in one batch. What
    :func:`tallyho.operators.board.coalesce_deltas` gives for the batch changelog."""
    every_us = int(every_seconds) * 1_000_000
    rows = _counted(mentions, retention_minutes, watermark, None, row_buckets, name_buckets, every_us)
    return rows.select(F.timestamp_micros("change_us").alias("bucket"), "name", F.col("n").alias("count"))


def changelog(batch: DataFrame, pieces: str) -> DataFrame:
    """(name, event_id, kind, change_ts, n) of one batch of :func:`trailing_stream`; the
    batch is read more than once, and ``pieces`` is a folder for its cut."""
    steps = batch.where(F.col("kind").isin(ARRIVAL, EXPIRY)).withColumnRenamed("n", "d")
    base = batch.where(F.col("kind") == BASE).select(F.col("name").alias("of"), F.col("n").alias("base"))
    summed = running_sum(
        steps.select("name", "event_id", "kind", "change_us", "d"), ["name"], ["change_us", "d", "event_id"], "d", "sum", path=pieces
    )
    return summed.join(base, F.col("name") == F.col("of")).select(
        "name", "event_id", "kind", F.timestamp_micros("change_us").alias("change_ts"), (F.col("base") + F.col("sum")).alias("n")
    )


def changelog_sink(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that writes the changelog of a batch of :func:`trailing_stream` under
    ``batch=<id>``. The batch is computed once and held in one of a few folders in
    turn, beside ``out``, which a repeated batch overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = f"{out}-steps/slot={batch_id % _SLOTS}"
        batch.write.mode("overwrite").parquet(held)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(held)
        done = rows.sparkSession.createDataFrame([], CHANGELOG_SCHEMA)
        if not rows.isEmpty():
            done = changelog(rows, f"{out}-pieces/slot={batch_id % _SLOTS}")
        done.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write
