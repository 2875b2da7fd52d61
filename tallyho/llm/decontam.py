"""Operator 7, benchmark decontamination by one Aho-Corasick automaton.

Every benchmark item is normalised to words, and the words to numbers; each run of
13 of them (or the whole item, if it has fewer) is a window. A document is
normalised the same way and scanned once by an automaton over word numbers; every
window found marks its words as hit. Word numbers map back to character offsets of the
original text.

The automaton holds each item in blocks of 7 words, end to end, and short items as a
whole. Any 13 consecutive words of an item hold one of its blocks whole, so a match
leaves at most 7 places where a window can begin; what begins there is looked up
among all windows by word numbers, exactly. So the automaton has three nodes for a word of
an item (a number is three digits, so that nodes have few children), not 13 for each of its
letters, and a block or window that many items share costs one look-up.

The items are broadcast, after a check of their size: ``BLOCK_BYTES`` of text make one
automaton, of about 200 MB. What is over goes to further ones, each in a job of its own
over the table that the one before has written, so a task holds one
automaton at a time. Nothing is shuffled. A Python worker builds an automaton once and
keeps it beside the broadcast items.

Defined results: null and empty texts have no words and no hits; items without
words have no windows. Equal windows of several items count for all of them.
Repeated rows are judged each. An empty benchmark contaminates nothing. The
input's columns come back in one struct, ``row``. Texts of any length are scanned
whole; one text and its words' places must fit in a worker.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.session import configure

from .store import written
from .words import with_row

WINDOW = 13
#: Contaminated from this share of hit words.
SHARE = 20
#: Words of a block: any window of an item holds one of its blocks whole.
BLOCK = (WINDOW + 1) // 2
#: Digits of a word's number.
DIGITS = 3
#: Item text of one automaton.
BLOCK_BYTES = 5_000_000
#: A run of so many words is told by two runs of the size before it, at its ends.
_SIZES = (1, 2, 4, 8, WINDOW)
#: Places looked up at a time.
_PLACES = 100_000

# Letters A-Z, lower-cased, a-z, digits and all bytes of non-ASCII characters
# make words; all else separates.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def blocks(items: Iterator[tuple[str, bytes]], limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in lists of about ``limit`` bytes of text."""
    block: list[tuple[str, bytes]] = []
    room = limit
    for item, text in items:
        if block and room < len(text):
            yield block
            block, room = [], limit
        block.append((item, text))
        room -= len(text)
    if block:
        yield block


def _pairs(ranks: np.ndarray, shift: int) -> np.ndarray:
    """A number for each pair of ranks that lie ``shift`` apart; 0 if one of them is."""
    n = max(ranks.shape[-1] - shift, 0)
    left, right = ranks[..., :n], ranks[..., shift : shift + n]
    return np.where((left > 0) & (right > 0), (left << 31) | right, 0)


def _rank(table: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Place of each pair in the sorted table, from 1; 0 if it isn't there."""
    at = np.searchsorted(table, pairs)
    if not len(table):
        return at
    return np.where((pairs > 0) & (table[np.minimum(at, len(table) - 1)] == pairs), at + 1, 0)


class Windows:
    """The automaton of some items, and their windows by the numbers of their words.

    ``tables`` has, for each size of runs, the sorted pairs of shorter runs: a run's
    rank is its place there, so equal ranks mean equal words. Runs with a word
    that no item has, and runs across the border of two items, have rank 0.
    """

    def __init__(self, items: list[tuple[str, bytes]]):
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        name = {item: k for k, item in enumerate(self.names)}
        found: dict[tuple[int, ...], tuple[bool, int, list[int]]] = {}
        runs, lengths, owners = [np.zeros(0, np.int64)], [], []
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal_words(text)]
            if len(words) >= WINDOW:
                for k in range(0, len(words) - BLOCK + 1, BLOCK):
                    key = tuple(words[k : k + BLOCK])
                    found[key] = (True, *found.get(key, (False, 0, []))[1:])
                runs.append(np.array([*words, 0], np.int64))
                lengths.append(len(words) + 1)
                owners.append(name[item])
            elif words:
                key = tuple(words)
                block, _, own = found.get(key, (False, 0, []))
                found[key] = (block, len(words), sorted({*own, name[item]}))
        # Each digit has signs of its own, so matches begin and end with words.
        self.base = max(64, math.ceil((len(self.numbers) + 1) ** (1 / 3)) + 1)
        self.tree = ahocorasick.Automaton()
        for key, value in found.items():
            self.tree.add_word(self._digits(np.array(key, np.int64)), value)
        if found:
            self.tree.make_automaton()
        self.any = bool(found)
        ranks, self.tables = np.concatenate(runs), []
        for size, longer in zip(_SIZES, _SIZES[1:], strict=False):
            pairs = _pairs(ranks, longer - size)
            self.tables.append(np.unique(pairs[pairs > 0]))
            ranks = _rank(self.tables[-1], pairs)
        owner = np.repeat(np.array(owners, np.int64), lengths)[: len(ranks)]
        held = np.unique(np.stack([ranks[ranks > 0], owner[ranks > 0]], axis=1), axis=0)
        #: items of the window of rank r: owners[first[r - 1] : first[r]]
        self.first = np.searchsorted(held[:, 0], np.arange(1, len(self.tables[-1]) + 2))
        self.owners = held[:, 1].astype(np.int32)

    def _digits(self, numbers: np.ndarray) -> str:
        digits = np.empty((len(numbers), DIGITS), "<u4")
        for k in range(DIGITS):
            digits[:, k] = numbers // self.base**k % self.base + k * self.base
        return digits.tobytes().decode("utf-32-le")

    def at(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rank of the window that begins at each place of a document."""
        ranks = words[starts[:, None] + np.arange(WINDOW)]
        for table, size, longer in zip(self.tables, _SIZES, _SIZES[1:], strict=False):
            ranks = _rank(table, _pairs(ranks, longer - size))
        return ranks[:, 0]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """(mark of each word, items) of a document's normalised words."""
        get = self.numbers.get
        n = len(words)
        numbers = np.array([get(w, 0) for w in words], np.int64)
        edges, near = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        own: set[int] = set()
        for end, (block, size, items) in self.tree.iter(self._digits(numbers)):
            end //= DIGITS
            if size:
                edges[end + 1 - size] += 1
                edges[end + 1] -= 1
                own.update(items)
            if block:  # a window around it begins up to WINDOW - BLOCK words before
                near[max(end + 1 - WINDOW, 0)] += 1
                near[end + 2 - BLOCK] -= 1
        if near.any():
            starts = np.flatnonzero(np.cumsum(near)[: max(n - WINDOW + 1, 0)])
            for k in range(0, len(starts), _PLACES):
                part = starts[k : k + _PLACES]
                ranks = self.at(numbers, part)
                part, ranks = part[ranks > 0], np.unique(ranks[ranks > 0])
                edges[part] += 1
                np.subtract.at(edges, part + WINDOW, 1)
                for r in ranks:
                    own.update(self.owners[self.first[r - 1] : self.first[r]].tolist())
        if not own:
            return np.zeros(0, bool), []
        return np.cumsum(edges[:-1]) > 0, sorted(self.names[k] for k in own)


def char_spans(text: str, marked: np.ndarray) -> list[dict[str, int]]:
    """Character ranges [start, end) of the original text that runs of marked
    words cover."""
    edges = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    if not edges.any():
        return []
    words = [m.span() for m in WORD.finditer(text)]
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return [{"start": words[b][0], "end": words[e - 1][1]} for b, e in zip(begins, ends, strict=True)]


def _scan_block(df: DataFrame, text: str, block: list[tuple[str, bytes]]) -> DataFrame:
    """Add a block's matches to the marks and items that ``df`` has."""
    configure(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast({"items": block})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "windows" not in held:
            held["windows"] = Windows(held["items"])
        found = held["windows"]
        for batch in batches:
            rows, _, marks, items = batch.columns
            counts, all_marks, all_items = [], [], []
            texts = pc.struct_field(rows, text).cast(pa.binary())
            for value, mark, item in zip(texts, marks, items, strict=True):
                words = normal_words(value.as_py() or b"")
                hit, own = found.scan(words) if found.any and words else (np.zeros(0, bool), [])
                old = mark.as_py()
                if own and old is not None:
                    hit = hit | np.unpackbits(np.frombuffer(old, np.uint8), count=len(words)).astype(bool)
                counts.append(len(words))
                all_marks.append(np.packbits(hit).tobytes() if own else old)
                all_items.append(sorted({*own, *item.as_py()}) if own else item.as_py())
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(counts, pa.int64()), pa.array(all_marks, pa.binary()), pa.array(all_items, pa.list_(pa.string()))],
                names=batch.schema.names,
            )

    return df.mapInArrow(run, df.schema)


def scan_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` as struct ``row`` with (n_words, n_hit, items, spans,
    contaminated); spans are character ranges of the original text."""
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(item_text)).where(F.col(item_text).isNotNull())
    df = with_row(docs).select(
        "row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("binary").alias("marks"), F.array().cast("array<string>").alias("items")
    )
    items = ((str(i), t.encode()) for i, t in rows.toLocalIterator())
    rest = blocks(items, block_bytes)
    df = _scan_block(df, text, next(rest, []))
    for block in rest:
        df = _scan_block(written(df, "decontamination"), text, block)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, counts, marks, items = batch.columns
            n_hit, spans = [], []
            for at, (n, mark) in enumerate(zip(counts.to_pylist(), marks, strict=True)):
                hit = np.zeros(0, bool)
                if mark.is_valid:
                    hit = np.unpackbits(np.frombuffer(mark.as_py(), np.uint8), count=n).astype(bool)
                n_hit.append(int(hit.sum()))
                spans.append(char_spans(rows[at].as_py()[text], hit) if len(hit) else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [rows, counts, pa.array(n_hit, pa.int64()), items, pa.array(spans, kind)],
                names=["row", "n_words", "n_hit", "items", "spans"],
            )

    schema = T.StructType(
        [
            df.schema["row"],
            *T._parse_datatype_string(
                "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"
            ).fields,
        ]
    )
    return df.mapInArrow(finish, schema).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )
