"""Landed segments as a stream (S6, S7, S8): a Python data source whose offset is the
high-water mark.

``spark.readStream.format("segments").load(folder)`` offers each 15-minute segment that
lands in a folder once, as (file_name, path, late). A segment is a file or a sub-folder
that is called ``yyyyMMddHHmm00.gkg.csv``, or ``<column>=`` and that. The offset holds the
newest name offered, and the segments below it that have not landed (as ranges, so its
size follows the gaps, not the segments). A segment that lands behind the mark is on that
list; it is offered when it comes, with ``late`` set. What a batch offers follows from its
two offsets alone, so a repeated batch is the same whatever has landed since, and a
restarted query goes on from its checkpoint.

Options: ``mark``, the newest segment that counts as seen before the first run (default:
see :mod:`tallyho.operators.segments`); ``namesPerTask``, the rows of a task. Each trigger
lists the folder once, on the driver: one name per 15 minutes of the feed. The folder
must be on a path that the driver can list (a mounted one); the segments' contents are
read by Spark from ``path``.

Names off the 15-minute grid are no segments and are never offered.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.segments import DEFAULT_MARK

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "file_name string, path string, late boolean"
SUFFIX = "00.gkg.csv"
_STEP = dt.timedelta(minutes=15)
_STAMP = "%Y%m%d%H%M"
_NAME = re.compile(r"(?:^|=)([0-9]{12})00\.gkg\.csv$")


def local_folder(uri: str) -> str:
    """Path of a mounted folder as the driver lists it."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"{uri}: segments are listed on a mounted path")
    return uri


def slot_of(name: str) -> dt.datetime | None:
    """The slot of a segment's name; None if it is none."""
    found = _NAME.search(name)
    try:
        slot = dt.datetime.strptime(found[1], _STAMP) if found else None
    except ValueError:
        return None
    return slot if slot and slot.minute % 15 == 0 else None


def name_of(slot: dt.datetime) -> str:
    return slot.strftime(_STAMP) + SUFFIX


def _slots(first: dt.datetime, last: dt.datetime) -> Iterator[dt.datetime]:
    while first <= last:
        yield first
        first += _STEP


def _ranges(slots: list[dt.datetime]) -> list[str]:
    """Sorted slots as ``from-to`` ranges of neighbours."""
    out: list[list[dt.datetime]] = []
    for s in slots:
        if out and s - out[-1][1] == _STEP:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [f"{a.strftime(_STAMP)}-{b.strftime(_STAMP)}" for a, b in out]


def _of_ranges(ranges: list[str]) -> set[dt.datetime]:
    out: set[dt.datetime] = set()
    for r in ranges:
        out.update(_slots(*(dt.datetime.strptime(x, _STAMP) for x in r.split("-"))))
    return out


def next_offset(after: str, landed: set[dt.datetime]) -> dict:
    """The offset once all that landed behind ``after`` is offered."""
    first = slot_of(after)
    new = [s for s in landed if s > first]
    mark = max(new, default=first)
    return {"after": after, "mark": name_of(mark), "missing": _ranges([s for s in _slots(first + _STEP, mark) if s not in landed])}


def offered(start: dict, end: dict) -> list[tuple[str, bool]]:
    """(name, whether late) of the segments between two offsets, by name."""
    known, still = _of_ranges(start["missing"]), _of_ranges(end["missing"])
    mark = slot_of(start["mark"])
    late = [(name_of(s), True) for s in sorted(known - still)]
    return late + [(name_of(s), False) for s in _slots(mark + _STEP, slot_of(end["mark"])) if s not in still]


class Names(InputPartition):
    def __init__(self, rows: list[tuple[str, str, bool]]):
        self.rows = rows


class SegmentReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder = local_folder(options["path"])
        self.uri = options["path"].rstrip("/")
        self.after = options.get("mark", DEFAULT_MARK)
        self.per_task = int(options.get("namespertask", 1000))
        if slot_of(self.after) is None:
            raise ValueError(f"{self.after} is no segment name")

    def _landed(self) -> dict[dt.datetime, str]:
        names = sorted(os.listdir(self.folder)) if os.path.isdir(self.folder) else []
        return {slot: n for n in names if (slot := slot_of(n)) is not None}

    def initialOffset(self) -> dict:
        return {"after": self.after, "mark": self.after, "missing": []}

    def latestOffset(self) -> dict:
        return next_offset(self.after, set(self._landed()))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        landed = self._landed()
        rows = [(n, f"{self.uri}/{landed.get(slot_of(n), n)}", late) for n, late in offered(start, end)]
        return [Names(rows[k : k + self.per_task]) for k in range(0, len(rows), self.per_task)] or [Names([])]

    def read(self, partition: Names) -> Iterator[tuple]:
        return iter(partition.rows)

    def commit(self, end: dict) -> None:
        pass


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(dict(self.options))


def arriving_segments(spark: SparkSession, folder: str, mark: str = DEFAULT_MARK) -> DataFrame:
    """Streaming (file_name, path, late) of the segments that land in ``folder``."""
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format("segments").option("mark", mark).load(folder)
