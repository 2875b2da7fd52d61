"""Words of whole texts as numpy arrays: the kernel under operators 2, 4 and 8.

A batch of texts is one UTF-8 buffer. Words are maximal runs of bytes other
than ASCII white space, and every word, line or window of words gets a 64-bit
hash. Nothing here loops over words in Python.

A text's hash is a polynomial in ``STEP`` over random per-byte codes, taken as
a difference of prefix sums modulo 2**64 and scrambled, so equal byte ranges
have equal hashes wherever they stand. Two different ranges collide with a
chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyho.session import configure

# Working memory per slice is about 60 bytes for each text byte.
SLICE_BYTES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_CODES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C13)
_STEP_INVERSE = np.uint64(pow(int(STEP), -1, 2**64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    return x ^ (x >> np.uint64(33))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", STEP), ("down", _STEP_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


class Texts:
    """Texts laid end to end: ``data`` bytes, text i at ``at[i]:at[i + 1]``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool):
        self.at = at
        self.n = len(at) - 1
        self.data = _LOWER[data] if lower else data
        solid = ~_SPACE[self.data]
        joint = np.zeros(len(data) + 1, bool)  # a text begins (or ends) here
        joint[at] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0], after[-1] = False, False
            before[1:], after[:-1] = solid[:-1], solid[1:]
        self.starts = np.flatnonzero(solid & ~(before & ~joint[:-1]))
        self.ends = np.flatnonzero(solid & ~(after & ~joint[1:])) + 1
        self.solid = solid
        #: words of text i are numbers first[i] up to first[i + 1]
        self.first = np.searchsorted(self.starts, at)
        self._sums: np.ndarray | None = None

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte range."""
        up, down = _power_table(len(self.data))
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_CODES[self.data] * up[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * down[np.minimum(starts, len(down) - 1)])

    def words(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def owner(self, starts: np.ndarray) -> np.ndarray:
        """The text that each byte position lies in."""
        return np.searchsorted(self.at, starts, side="right") - 1

    def count(self, marked: np.ndarray) -> np.ndarray:
        """Marked bytes of each text."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(marked, out=sums[1:])
        return sums[self.at[1:]] - sums[self.at[:-1]]


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; run i begins at word i."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * STEP + words[k : k + len(out)])
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, lower: bool = True, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Cut a column of texts into row ranges (begin, end, Texts) of about
    ``size`` bytes. A longer text is a slice of its own; it is never cut."""
    data, at = text_buffer(texts)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, Texts(data[at[row] : at[end]], at[row : end + 1] - at[row], lower)
        row = end


def with_row(df: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that columns an operator adds
    can't clash with them; ``select("row.*")`` gives them back."""
    return df.select(F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns)).alias("row"))


def map_texts(
    docs: DataFrame,
    text: str,
    measure: Callable[[Texts], dict[str, Any]],
    fields: dict[str, str],
    lower: bool = True,
    size: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` as ``row``, with columns ``fields`` (name: type) that
    ``measure`` makes from each slice of whole texts. No shuffle."""
    configure(docs.sparkSession)
    rows = with_row(docs)
    added = T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items()])
    kinds = {f.name: to_arrow_type(f.dataType) for f in added}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, t in slices(pc.struct_field(batch.column(0), text), lower, size):
                got = measure(t)
                arrays = [
                    got[k].cast(kind) if isinstance(got[k], pa.Array) else pa.array(got[k], kind)
                    for k, kind in kinds.items()
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), *arrays], names=["row", *kinds]
                )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added.fields]))
