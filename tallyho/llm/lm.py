"""Operator 2, an interpolated modified Kneser-Ney n-gram model.

Training counts n-grams on Spark: tasks count the grams of their own texts,
Spark shuffles the partial counts to shards by ranges of the gram's hash, sorted
by finer ranges, the buckets. A shard sums its grams a bucket at a time and
stores them as one file of sorted hash arrays in the shared folder. From its
grams a shard also makes what the next lower order needs: for the context of a
gram the total and how many grams occur once, twice and more often, and for
the gram without its first word one continuation. These go to the next order's
shards, down to the empty gram. Counts of counts, which give the discounts, are
the only thing that reaches the driver.

Partial counts travel in blocks, one for each bucket of a portion: grams in the
order of their words' numbers, as differences, in compressed byte planes. Frequent
words have small numbers, so a gram takes about five bytes.

Scoring maps the arrays into memory. A worker holds the pages that it touches,
which the system may drop again, so its own memory doesn't grow with the model.
A slice of text looks its distinct grams up in each shard once, in sorted order;
a shard holds the grams of up to ``SHARD_BYTES`` of text.

A text is its words (lower-cased A-Z) and one end token. Words are known by
64-bit hashes and numbered by their rank in their bucket; grams are found by a
64-bit hash of their numbers, of which large shards keep at least 40 bits besides
the cell: two grams of a model are taken for each other with a chance of about
2^-37. The unigram level is interpolated with the uniform distribution over the
vocabulary and one unknown word.

Defined results: null and empty texts are the end token alone. Rows are scored
each; a row with a null id is used for training. With nothing to train on, every
token has probability 1 (there is only the unknown word). The input's columns come
back in one struct, ``row``. Texts are read whole, and one text takes about 60
bytes of a worker for each of its bytes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import fresh_path, local_path

#: Order of the registered model.
ORDER = 3
#: Text bytes for each shard of the arrays, at most; a shard is stored by one task.
SHARD_BYTES = 256_000_000
MIN_SHARDS = 16
#: Text bytes for each bucket of a shard, at most; a bucket is summed in memory.
BUCKET_BYTES = 8_000_000
#: Tokens that a counting task holds before it hands on their counts.
HOLD = 4_000_000
#: Tokens whose numbers are looked up at a time.
NUMBERED = 1_000_000
#: Text bytes scored at a time.
SLICE_BYTES = 3_000_000
SMOOTHING = 0.1

BEGIN, UNKNOWN, FIRST = 0, 1, 2  # numbers; vocabulary words follow
_END = np.uint64(0x5BD1E9955BD1E995)
MAX_ORDER = 5


# --- arrays -----------------------------------------------------------------


def _summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Sorted distinct keys, the values summed by key, and a row of each key."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], [np.add.reduceat(v[order], new) if len(new) else v[:0] for v in values], order[new]


def _file(folder: str, table: str, shard: int) -> str:
    return f"{folder}/{table}-{shard:06d}"


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _mixed(values: list[np.ndarray]) -> np.ndarray:
    """One hash for the values of each row."""
    out = np.zeros(len(values[0]), np.uint64)
    for v in values:
        out = W.mix(out * W.STEP + v.astype(np.uint64))
    return out


#: Keys in a cell of the index, about; keys in a block of cells with a base of their own.
_CELL, _BLOCK = 4, 24
#: Bits of a key kept besides its cell; tables of fewer keys than ``_FULL`` keep all.
_KEPT, _FULL = 40, 65_536


class Writer:
    """Writes one shard: sorted keys in cells by their first bits, of which the
    rest is stored, and value columns. Value tuples are numbered, as nearly
    all are among a few; the others stand apart. ``add`` takes ascending
    ranges of keys, the first of which sets cell width and numbered tuples.

    The file appears whole or not at all, so a repeated task just replaces it
    by the same.
    """

    def __init__(self, folder: str, table: str, shard: int, low: int = 0, bits: int = 64, parts: int = 1):
        """Keys lie in the ``2**bits`` from ``low``, evenly spread over ``parts`` ranges."""
        self.path = _file(folder, table, shard)
        os.makedirs(folder, exist_ok=True)
        self.low, self.bits, self.parts = np.uint64(low), bits, parts
        self.n = 0
        self.columns: list[list[np.ndarray]] = []

    def _begin(self, n: int, values: list[np.ndarray]) -> None:
        cells = max(0, (n * self.parts // _CELL).bit_length() - 1)
        self.shift = min(max(self.bits - cells, 0), 63)
        self.dropped = max(0, self.shift - _KEPT) if n * self.parts >= _FULL else 0
        self.sizes = np.zeros((1 << (self.bits - self.shift)) if self.bits > self.shift else 1, np.uint32)
        mixed, (count,), at = _summed(_mixed(values), [np.ones(n, np.int64)])
        often = np.argsort(-count, kind="stable")
        apart = 8 + 8 * len(values)
        costs = {k: n * k + apart * int(count[often[256**k - 1 :]].sum()) for k in (1, 2)}
        self.escape = 256 ** min(costs, key=costs.get) - 1
        often = often[: self.escape]
        self.tuples = [_narrow(v[at[often]]) for v in values]
        order = np.argsort(mixed[often])
        self.known, self.code = mixed[often][order], order

    def add(self, keys: np.ndarray, values: list[np.ndarray], raw: list[np.ndarray] | None = None) -> None:
        if not len(keys):
            return
        if not self.n:
            self._begin(len(keys), values)
        keys = keys - self.low
        cell = keys >> np.uint64(self.shift)
        first = int(cell[0])
        sizes = np.bincount((cell - np.uint64(first)).astype(np.int64))
        self.sizes[first : first + len(sizes)] += sizes.astype(np.uint32)
        rest = (keys & np.uint64((1 << self.shift) - 1)) >> np.uint64(self.dropped)
        mixed = _mixed(values)
        at = np.searchsorted(self.known, mixed)
        at[at == len(self.known)] = 0
        codes = np.where(self.known[at] == mixed, self.code[at], self.escape)
        apart = np.flatnonzero(codes == self.escape)
        self.columns.append(
            [
                rest.astype(np.uint32),
                _narrow(rest >> np.uint64(32)),
                codes.astype(np.min_scalar_type(self.escape)),
                _narrow(apart + self.n),
                *(_narrow(v[apart]) for v in values),
                *map(_narrow, raw or []),
            ]
        )
        self.n += len(keys)

    def finish(self) -> None:
        if not self.n:
            return
        ends = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])
        coarse = ends[::_BLOCK]
        fine = _narrow(ends - np.repeat(coarse, _BLOCK)[: len(ends)])
        parts = [np.array([int(self.low), self.shift, self.dropped, self.escape, len(self.tuples)], np.uint64), coarse, fine]
        parts += self.tuples
        for k in range(len(self.columns[0])):
            parts.append(np.concatenate([c[k] for c in self.columns]))
            for c in self.columns:
                c[k] = c[k][:0]
        head = np.array([x for c in parts for x in (len(c), c.dtype.itemsize)], np.int64)
        part = f"{self.path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            for c in (np.array([len(head)], np.int64), head, *parts):
                f.write(np.ascontiguousarray(c).data)
                f.write(b"\0" * (-c.nbytes % 8))
        os.replace(part, self.path)


def _save(folder: str, table: str, shard: int, keys: np.ndarray, values: list[np.ndarray]) -> None:
    """A shard from all its sorted keys at once."""
    low = int(keys[0]) if len(keys) else 0
    writer = Writer(folder, table, shard, low, (int(keys[-1]) - low).bit_length() if len(keys) else 0)
    writer.add(keys, values)
    writer.finish()


class Shard:
    """A mapped file of :class:`Writer`."""

    def __init__(self, path: str):
        raw = np.asarray(np.memmap(path, np.uint8, "r"))
        n_head = int(raw[:8].view(np.int64)[0])
        head = raw[8 : 8 + 8 * n_head].view(np.int64).reshape(-1, 2).tolist()
        at, parts = 8 + 8 * n_head, []
        for n, width in head:
            parts.append(raw[at : at + n * width].view(np.dtype(f"u{width}")))
            at += n * width + -n * width % 8
        self.low, shift, dropped, escape, m = parts[0].tolist()
        self.shift, self.dropped, self.escape = np.uint64(shift), np.uint64(dropped), int(escape)
        self.coarse, self.fine = parts[1:3]
        self.tuples = parts[3 : 3 + m]
        self.rest, self.above, self.codes, self.places = parts[3 + m : 7 + m]
        self.apart = parts[7 + m : 7 + 2 * m]
        self.raw = parts[7 + 2 * m :]

    def _start(self, cell: np.ndarray) -> np.ndarray:
        return self.coarse[cell // _BLOCK].astype(np.int64) + self.fine[cell]

    def places_of(self, keys: np.ndarray) -> np.ndarray:
        """The place of each of the sorted keys, or -1."""
        out = np.full(len(keys), -1, np.int64)
        begin = int(np.searchsorted(keys, np.uint64(self.low)))
        own = keys[begin:] - np.uint64(self.low)
        cell = (own >> self.shift).astype(np.int64)
        cell = cell[: np.searchsorted(cell, len(self.fine) - 1)]
        rest = (own[: len(cell)] & ((np.uint64(1) << self.shift) - np.uint64(1))) >> self.dropped
        here, end = self._start(cell), self._start(cell + 1)
        left = np.flatnonzero(here < end)
        here, end, below = here[left], end[left], rest[left].astype(np.uint32)
        while len(left):
            same = self.rest[here] == below
            hit = np.flatnonzero(same)
            exact = self.above[here[hit]] == rest[left[hit]] >> np.uint64(32)
            out[begin + left[hit[exact]]] = here[hit[exact]]
            same[hit[~exact]] = False
            here += 1
            on = ~same & (here < end)
            left, here, end, below = left[on], here[on], end[on], below[on]
        return out

    def values(self, places: np.ndarray) -> list[np.ndarray]:
        codes = self.codes[places]
        apart = np.flatnonzero(codes == self.escape)
        codes = codes.astype(np.int64)
        codes[apart] = 0
        of = np.searchsorted(self.places, places[apart].astype(self.places.dtype))
        out = []
        for own, others in zip(self.tuples, self.apart, strict=True):
            v = own[codes].astype(np.int64)
            v[apart] = others[of].astype(np.int64)
            out.append(v)
        return [*out, *(r[places].astype(np.int64) for r in self.raw)]


@dataclass
class Arrays:
    """A table of sorted hash arrays, mapped shard by shard when first used."""

    folder: str
    table: str
    mapped: dict = field(default_factory=dict)

    def shard(self, shard: int) -> Shard | None:
        if shard not in self.mapped:
            path = _file(self.folder, self.table, shard)
            self.mapped[shard] = Shard(path) if os.path.exists(path) else None
        return self.mapped[shard]

    def find(self, keys: np.ndarray, shards: np.ndarray, n_values: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(place in the shard or -1, the values or 0) of each key."""
        order = np.lexsort((keys, shards)) if (shards[1:] != shards[:-1]).any() else np.argsort(keys)
        return self._found(keys[order], shards[order], order, n_values)

    def look(self, keys: np.ndarray, shard_bits: int, n_values: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """``find`` where a shard is a range of keys."""
        order = np.argsort(keys)
        keys = keys[order]
        return self._found(keys, (keys >> np.uint64(64 - shard_bits)).astype(np.int64), order, n_values)

    def _found(
        self, keys: np.ndarray, shards: np.ndarray, order: np.ndarray, n_values: int
    ) -> tuple[np.ndarray, list[np.ndarray]]:
        n = len(keys)
        new = np.ones(n, bool)
        new[1:] = (keys[1:] != keys[:-1]) | (shards[1:] != shards[:-1])
        back = np.empty(n, np.int64)
        back[order] = np.cumsum(new) - 1
        keys, shards = keys[new], shards[new]
        place = np.full(len(keys), -1, np.int64)
        values = [np.zeros(len(keys), np.int64) for _ in range(n_values)]
        cuts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1], [True]])) if n else [0]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            mapped = self.shard(int(shards[begin]))
            if mapped is None:
                continue
            at = mapped.places_of(keys[begin:end])
            place[begin:end] = at
            hit = np.flatnonzero(at >= 0)
            for v, c in zip(values, mapped.values(at[hit]), strict=True):
                v[begin + hit] = c
        return place[back], [v[back] for v in values]


# --- tokens -----------------------------------------------------------------


def token_hashes(t: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end token included, and the number of
    each text's tokens."""
    counts = np.diff(t.first) + 1
    out = np.full(len(t.starts) + t.n, _END, np.uint64)
    ends = np.cumsum(counts) - 1
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word] = t.words()
    return out, counts


def gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    return _mixed(ids)


@dataclass
class Vocabulary:
    folder: str
    shard_bits: int
    n_words: int  # distinct
    n_tokens: int
    max_id: int

    def number(self, hashes: np.ndarray, arrays: Arrays) -> tuple[np.ndarray, np.ndarray]:
        """(number, training count) of each token."""
        place, (count, ids) = arrays.look(hashes, self.shard_bits, 2)
        return np.where(place >= 0, ids, UNKNOWN), count


def grams(ids: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """The numbers of the ``order`` words up to each token; texts begin with
    as many begin marks as are needed."""
    first = np.cumsum(counts) - counts
    out = []
    for back in range(order - 1, -1, -1):
        moved = np.zeros(len(ids), ids.dtype)
        moved[back:] = ids[: len(ids) - back]
        for k in range(back):  # the first tokens of texts, where they have as many
            moved[first[counts > k] + k] = BEGIN
        out.append(moved)
    return out


# --- training ---------------------------------------------------------------

#: A block of rows for one bucket. ``kind`` says what they are: grams with their
#: counts, contexts with what is known of their grams, or a few sums for the end.
BLOCK = "bucket bigint, kind int, data binary"
GRAMS, CONTEXTS, SUMS = 0, 1, 2
#: What is kept of a gram as a context: the total of its grams and how many of
#: them have count 1, 2, and 3 or more.
_CONTEXT = 4


@dataclass(frozen=True)
class Ranges:
    """Hashes fall into ``2**shard_bits`` shards, each of ``2**inner_bits`` buckets."""

    shard_bits: int
    inner_bits: int

    @classmethod
    def of(cls, size: int, shard_bytes: int, bucket_bytes: int) -> Ranges:
        shard_bits = max(MIN_SHARDS - 1, -(-size // shard_bytes) - 1).bit_length()
        return cls(shard_bits, max(0, (-(-size // bucket_bytes) - 1).bit_length() - shard_bits))

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.shard_bits - self.inner_bits)).astype(np.int64)

    def shuffled(self, blocks: DataFrame) -> DataFrame:
        """A shard's blocks in one partition, its buckets one after the other."""
        shard = F.shiftright("bucket", self.inner_bits).cast("int")
        return blocks.repartitionById(1 << self.shard_bits, shard).sortWithinPartitions("bucket")

    def writer(self, folder: str, table: str, shard: int) -> Writer:
        bits = 64 - self.shard_bits
        return Writer(folder, table, shard, shard << bits, bits, 1 << self.inner_bits)


def _planes(columns: list[np.ndarray]) -> bytes:
    """Columns of one length as compressed byte planes."""
    head = np.array([len(columns[0]), len(columns), *(c.dtype.itemsize for c in columns)], np.int64)
    raw = b"".join(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return head.tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _from_planes(data: bytes) -> list[np.ndarray]:
    n, k = np.frombuffer(data, np.int64, 2).tolist()
    widths = np.frombuffer(data, np.int64, k, 16).tolist()
    raw = pa.decompress(data[16 + 8 * k :], n * sum(widths), codec="zstd", asbytes=True)
    out, at = [], 0
    for w in widths:
        planes = np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype(f"i{w}")))
        at += n * w
    return out


def _encode(ids: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Rows sorted by ``ids``: numbers as differences from the row before, anew
    where a number before them changes."""
    columns = []
    new = np.zeros(len(ids[0]), bool)
    new[0] = True
    for i in ids:
        step = i.copy()
        step[1:] -= i[:-1]
        columns.append(np.where(new, i, step))
        new = new | (step != 0)
    top = [int(v.max()) for v in values]
    return _planes([*columns, *(v.astype(np.int32 if t < 2**31 else np.int64) for v, t in zip(values, top, strict=True))])


def _decode(data: bytes, n_ids: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    columns = _from_planes(data)
    ids: list[np.ndarray] = []
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for step in columns[:n_ids]:
        # Running sums, less the sum before each fresh start.
        total = np.cumsum(step, dtype=np.int64)
        starts = np.flatnonzero(new)
        before = total[starts] - step[starts]
        own = (total - np.repeat(before, np.diff(np.append(starts, len(step))))).astype(step.dtype)
        ids.append(own)
        changed = np.ones(len(own), bool)
        changed[1:] = own[1:] != own[:-1]
        new = new | changed
    return ids, [v.astype(np.int64) for v in columns[n_ids:]]


def _distinct(ids: list[np.ndarray], values: list[np.ndarray], id_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct grams in the order of their numbers, values summed."""
    packed, room = [], 0
    for i in ids:
        if room < id_bits:
            packed.append(i.astype(np.uint64))
            room = 64 - id_bits
        else:
            packed[-1] = packed[-1] << np.uint64(id_bits) | i.astype(np.uint64)
            room -= id_bits
    order = np.argsort(packed[0]) if len(packed) == 1 else np.lexsort(packed[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for p in packed:
        p = p[order]
        new[1:] |= p[1:] != p[:-1]
    at = np.flatnonzero(new)
    return [i[order[at]] for i in ids], [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


def _counted(ids: list[np.ndarray], id_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct grams in the order of their numbers, and how often each is there."""
    if id_bits * len(ids) > 64:
        return _distinct(ids, [np.ones(len(ids[0]), np.int64)], id_bits)
    kind = ids[0].dtype
    packed = ids.pop(0).astype(np.uint64)
    width, n_more = np.uint64(id_bits), len(ids)
    while ids:
        packed <<= width
        packed |= ids.pop(0).astype(np.uint64)
    packed.sort()
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    at = np.flatnonzero(new)
    n = np.diff(at, append=len(packed))
    packed = packed[at]
    low = np.uint64((1 << id_bits) - 1)
    return [(packed >> np.uint64(id_bits * k) & low).astype(kind) for k in range(n_more, -1, -1)], [n]


def _blocks(
    ids: list[np.ndarray], values: list[np.ndarray], hashes: np.ndarray, ranges: Ranges, kind: int
) -> Iterator[pa.RecordBatch]:
    """Sorted rows as blocks by bucket."""
    bucket = ranges.bucket(hashes)
    order = np.argsort(_narrow(bucket), kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(order) else [0]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        at = order[begin:end]
        yield _block(int(bucket[begin]), kind, _encode([i[at] for i in ids], [v[at] for v in values]))


def _block(bucket: int, kind: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())],
        names=["bucket", "kind", "data"],
    )


def _turned(writer: Writer | None, ranges: Ranges, folder: str, table: str, bucket: int) -> Writer:
    """The writer of the bucket's shard; that of the shard before is finished."""
    shard = bucket >> ranges.inner_bits
    if writer and writer.path == _file(folder, table, shard):
        return writer
    if writer:
        writer.finish()
    return ranges.writer(folder, table, shard)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(bucket, its blocks as (kind, data)) in the order in which they come."""
    bucket, held = None, []
    for batch in batches:
        for b, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and b != bucket:
                yield bucket, held
                held = []
            bucket = b
            held.append((kind, data))
    if held:
        yield bucket, held


def _drained(held: list[np.ndarray]) -> np.ndarray:
    out = np.concatenate(held)
    held.clear()
    return out


def _held(column: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes and numbers of tokens, in portions of about ``HOLD`` tokens."""
    hashes: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    size = 0
    for batch in column:
        for _, _, t in W.slices(batch.column(0)):
            h, c = token_hashes(t)
            hashes.append(h)
            counts.append(c)
            size += len(h)
            if size >= HOLD:
                yield _drained(hashes), _drained(counts)
                size = 0
    if size:
        yield _drained(hashes), _drained(counts)


def build_vocabulary(texts: DataFrame, folder: str, ranges: Ranges) -> Vocabulary:
    """Count the tokens of (text) rows and store them as sorted arrays."""
    n_buckets = 1 << (ranges.shard_bits + ranges.inner_bits)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _ in _held(batches):
            keys, n = np.unique(hashes, return_counts=True)
            yield from _blocks([keys.view(np.int64)], [n], keys, ranges, GRAMS)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, sums = None, [0, 0, 0]
        for bucket, blocks in _by_bucket(batches):
            writer = _turned(writer, ranges, folder, "words", bucket)
            got = [_decode(data, 1) for _, data in blocks]
            keys, (count,), _ = _summed(
                np.concatenate([i[0].view(np.uint64) for i, _ in got]), [np.concatenate([v[0] for _, v in got])]
            )
            # Frequent words get small numbers.
            ids = np.empty(len(keys), np.int64)
            ids[np.argsort(-count, kind="stable")] = np.arange(len(keys)) * n_buckets + bucket + FIRST
            writer.add(keys, [count], [ids])
            sums = [sums[0] + len(keys), sums[1] + int(count.sum()), max(sums[2], int(ids.max()))]
        if writer:
            writer.finish()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums], names=["n", "c", "top"])

    counted = ranges.shuffled(texts.mapInArrow(partial, BLOCK))
    got = counted.mapInArrow(store, "n bigint, c bigint, top bigint").agg(F.sum("n"), F.sum("c"), F.max("top")).first()
    return Vocabulary(folder, ranges.shard_bits, *(x or 0 for x in got))


def _store_level(folder: str, ranges: Ranges, order: int, level: int, id_bits: int) -> Callable:
    """Sum and store the grams of ``level`` and make blocks for the level below;
    the last level gives the sums (level, a, b, c, d) alone."""

    def read(blocks: list[tuple[int, bytes]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Grams and values of a bucket's blocks; contexts have no count yet."""
        parts = []
        for kind, data in blocks:
            ids, values = _decode(data, level)
            if level < order:
                none = np.zeros(len(ids[0]), np.int64)
                values = [*values, *[none] * _CONTEXT] if kind == GRAMS else [none, *values]
            parts.append((ids, values))
        return tuple([np.concatenate(x) for x in zip(*side, strict=True)] for side in zip(*parts, strict=True))

    def lower(ids: list[np.ndarray], count: np.ndarray) -> Iterator[pa.RecordBatch]:
        # A gram that begins with the text's begin has no other left
        # neighbours; it keeps its count.
        grams_below, values = _distinct(ids[1:], [np.where(ids[1] == BEGIN, count, 1)], id_bits)
        yield from _blocks(grams_below, values, gram_hash(grams_below), ranges, GRAMS)
        kinds = [(count == 1).astype(np.int64), (count == 2).astype(np.int64), (count >= 3).astype(np.int64)]
        contexts, values = _distinct(ids[:-1], [count, *kinds], id_bits)
        yield from _blocks(contexts, values, gram_hash(contexts), ranges, CONTEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, last = None, 0
        sums: dict[int, np.ndarray] = {}
        for bucket, blocks in _by_bucket(batches):
            last = bucket
            for kind, data in blocks:
                if kind >= SUMS:
                    sums[kind - SUMS] = sums.get(kind - SUMS, 0) + np.frombuffer(data, np.int64)
            blocks = [b for b in blocks if b[0] < SUMS]
            if not blocks:
                continue
            writer = _turned(writer, ranges, folder, f"grams{level}", bucket)
            ids, values = read(blocks)
            keys, values, at = _summed(gram_hash(ids), values)
            writer.add(keys, values)
            real = values[0] > 0  # else it only occurs as a context
            count = values[0][real]
            found = np.array([(count == k).sum() for k in (1, 2, 3, 4)])
            sums[level] = sums.get(level, 0) + found
            if level > 1:
                ids = [i[at[real]] for i in ids]
                del keys, values, at
                yield from lower(ids, count)
            else:
                kinds = [count.sum(), (count == 1).sum(), (count == 2).sum(), (count >= 3).sum()]
                sums[0] = sums.get(0, 0) + np.array(kinds)
        if writer:
            writer.finish()
        for k, v in sums.items():
            if level > 1:
                yield _block(last, SUMS + k, v.astype(np.int64).tobytes())
            else:
                row = [pa.array([int(x)], pa.int64()) for x in (k, *v)]
                yield pa.RecordBatch.from_arrays(row, names=["level", *"abcd"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; halves of
    the counts where some count of counts is missing."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k) for d, k in zip(found, (1.0, 2.0, 3.0), strict=True))


@dataclass
class Model:
    """What scoring needs besides the arrays: a few numbers per level."""

    vocabulary: Vocabulary
    order: int
    discounts: dict[int, tuple[float, float, float]]
    total: int  # continuations of all words
    kinds: tuple[int, int, int]  # words by count 1, 2, 3 or more


def train(
    texts: DataFrame, order: int = ORDER, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> Model:
    """Train on the rows of a (text) column; the arrays go to a new folder of
    ``spark.checkpoint.dir``."""
    if not 1 < order <= MAX_ORDER:
        raise ValueError(f"order must be 2 to {MAX_ORDER}")
    texts = texts.select(F.col(texts.columns[0]).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = Ranges.of(size, shard_bytes, bucket_bytes)
    folder = local_path(fresh_path(texts.sparkSession, "lm"))
    vocabulary = build_vocabulary(texts, folder, ranges)
    id_bits = max(vocabulary.max_id, FIRST).bit_length()
    # Numbers travel in the narrower type while the vocabulary allows it.
    id_type = np.int32 if id_bits < 32 else np.int64

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(folder, "words")
        for hashes, counts in _held(batches):
            ids = np.empty(len(hashes), id_type)
            for at in range(0, len(ids), NUMBERED):
                ids[at : at + NUMBERED] = vocabulary.number(hashes[at : at + NUMBERED], arrays)[0]
            del hashes
            ids, n = _counted(grams(ids, counts, order), id_bits)
            yield from _blocks(ids, n, gram_hash(ids), ranges, GRAMS)

    df = texts.mapInArrow(partial, BLOCK)
    for level in range(order, 0, -1):
        shape = BLOCK if level > 1 else "level bigint, a bigint, b bigint, c bigint, d bigint"
        df = ranges.shuffled(df).mapInArrow(_store_level(folder, ranges, order, level, id_bits), shape)
    got = {r[0]: r[1:] for r in df.groupBy("level").agg(*(F.sum(c) for c in "abcd")).collect()}
    total = got.get(0, (0,) * 4)
    return Model(
        vocabulary,
        order,
        {k: discounts(*got.get(k, (0,) * 4)) for k in range(1, order + 1)},
        total[0],
        tuple(total[1:]),
    )


# --- scoring ----------------------------------------------------------------


def _discounted(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return count - np.array([0.0, *d])[np.minimum(count, 3)]


def probabilities(model: Model, ids: np.ndarray, counts: np.ndarray, arrays: dict[int, Arrays]) -> np.ndarray:
    """The model's probability of each token."""
    v = model.vocabulary
    uniform = 1 / (v.n_words + 1)
    if not model.total:
        return np.full(len(ids), uniform)
    first = np.cumsum(counts) - counts
    all_ids = grams(ids, counts, model.order)
    d = model.discounts[1]
    left = sum(x * n for x, n in zip(d, model.kinds, strict=True)) / model.total
    context: list[np.ndarray] = []
    for level in range(1, model.order + 1):
        keys = gram_hash(all_ids[model.order - level :])
        # The text's begin as the context of its first token.
        begin = gram_hash([np.full(1, BEGIN)] * level)
        values = arrays[level].look(np.concatenate([keys, begin]), v.shard_bits, 1 if level == model.order else 5)[1]
        count = values[0][:-1]
        d = model.discounts[level]
        if level == 1:
            p = _discounted(count, d) / model.total + left * uniform
        else:
            total, n1, n2, n3 = context
            own = (_discounted(count, d) + (d[0] * n1 + d[1] * n2 + d[2] * n3) * p) / np.maximum(total, 1)
            p = np.where(total > 0, own, p)
        # The context of a gram of the next level is this level's gram one
        # token earlier.
        context = []
        for c in values[1:]:
            moved = np.roll(c[:-1], 1)
            moved[first] = c[-1]
            context.append(moved)
    return p


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` as struct ``row`` with (n_tokens, n_known, base_score, score):
    log10 probabilities of the whole text under smoothed unigram counts and
    under the model."""
    v = model.vocabulary
    mapped: dict = {k: Arrays(v.folder, f"grams{k}") for k in range(1, model.order + 1)}
    mapped["words"] = Arrays(v.folder, "words")

    def measure(t: W.Texts) -> dict[str, np.ndarray]:
        hashes, counts = token_hashes(t)
        ids, seen = v.number(hashes, mapped["words"])
        base = np.log10((seen + SMOOTHING) / (v.n_tokens + SMOOTHING * (v.n_words + 1)))
        p = np.log10(probabilities(model, ids, counts, mapped))
        at = np.cumsum(counts) - counts
        return {
            "n_tokens": counts,
            "n_known": np.add.reduceat((seen > 0).astype(np.int64), at),
            "base_score": np.add.reduceat(base, at),
            "score": np.add.reduceat(p, at),
        }

    fields = {"n_tokens": "bigint", "n_known": "bigint", "base_score": "double", "score": "double"}
    return W.map_texts(docs, text, measure, fields, size=SLICE_BYTES)


def perplexity(score_column: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score_column / n_tokens)


def held_out(doc_id: Column, parts: int = 10) -> Column:
    """Whether a document is kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))
