"""Operator 6, a WARC data source in Python for Spark.

``spark.dataSource.register(WarcSource)``, then
``spark.read.format("warc").load(folder)`` and
``df.write.format("warc").save(folder)``.

Reading. Files are planned into partitions of about ``partitionBytes``. Filters on
the record type and on the header columns are pushed down; a record's headers
are parsed first, and where they fail the filters, or where the option
``payload`` is ``false``, the reader goes to the next record without reading the
payload. Plain files are skipped by the content length. Gzip files have one
member per record; their writer notes each member's length in the ``sl`` extra
field that the WARC standard describes, so members are skipped unread too
(a member without it must be unpacked to find its end). Lines may end in CRLF or LF.

Damage. A record is damaged if its file ends in it, its gzip member doesn't unpack
or fails its checksum, its content is shorter or longer than its ``Content-Length``, that is
missing or no number, or no record begins where one should. The option ``mode`` says
what happens: ``fail`` (default) raises an error that names file and place; ``report``
gives a row for it with what could be read and the column ``damage``, and goes on with
the next record that can be found. Payloads that are passed over aren't unpacked, so
of their damage only a file's end is noticed.

HTTP. With the option ``http`` = ``true`` the payload of a record of type
``application/http`` is taken apart: ``http_status``, ``http_headers`` (names in lower case,
repeated ones joined by commas), and the body, still encoded as it was sent, as
``payload``. Without a status line these are null and the payload is left whole.

Writing. Each task writes files of its own, one gzip member per record, under
a name that no other attempt has; the driver's commit renames the files of the
attempts that succeeded. So lost executors leave no half records.

Defined results: a null payload is written as an empty one; a null header
column writes no header and reads as null. Line ends in header values are
written as spaces. Unknown headers are kept in ``headers``. A folder without
files reads as empty. Files and payloads may be of any size; one payload must
fit in a task's memory, and a file is read by one task, so the writer begins a
new one after ``rollBytes``.

Load a folder anew for each query: Spark keeps a reader, and with it the filters
that were pushed down, as long as the DataFrame that ``load`` returned is used.

The folder must be on a path mounted on all machines.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from .store import local_path, written

# Header names of the standard, and of this library for the
# length of the payload that a revisit record leaves out.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
    "content_type": "Content-Type",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_SCHEMA = ", ".join(f"{column} string" for column in HEADERS) + ", headers map<string,string>"
SCHEMA = HEADER_SCHEMA + ", payload binary"
DAMAGE_SCHEMA = ", damage string"
HTTP_SCHEMA = ", http_status int, http_headers map<string,string>"
_READ = 64 * 1024
_SL_LIMIT = 1 << 32
#: Bytes in which a record's headers must end.
_MAX_HEAD = 4_000_000
_BATCH = 4_000_000


# --- records ----------------------------------------------------------------


def record_bytes(record: dict[str, Any]) -> tuple[bytes, bytes]:
    """(head, payload) of a record."""
    payload = record.get("payload") or b""
    lines = ["WARC/1.1"]
    fields = {HEADERS[k]: record[k] for k in HEADERS if record.get(k) is not None} | (record.get("headers") or {})
    for name, value in fields.items():
        lines.append(f"{name}: {re.sub(r'[\r\n]+', ' ', str(value))}")
    lines.append(f"Content-Length: {len(payload)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), bytes(payload)


def gzip_member(data: bytes) -> bytes:
    """One gzip member whose ``sl`` extra field holds its packed and unpacked
    length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 12 + 12 + len(body) + 8
    if max(total, len(data)) >= _SL_LIMIT:
        head, extra = b"\x1f\x8b\x08\0\0\0\0\0\0\xff", b""
    else:
        extra = b"sl" + struct.pack("<HII", 8, total, len(data))
        head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Unpacked:
    """A plain or gzip member's content, read as far as it is asked for."""

    def __init__(self, file: BinaryIO, packed: bool):
        self.file, self.have, self.unpacker = file, b"", None
        self.start, self.length = file.tell(), None
        if packed:
            self.unpacker = zlib.decompressobj(31)
            head = file.read(24)
            if len(head) == 24 and head[3] & 4 and head[12:16] == b"sl\x08\0":
                self.length = struct.unpack("<I", head[16:20])[0]
            file.seek(self.start)

    def more(self) -> bool:
        if self.unpacker is None:
            data = self.file.read(_READ)
            self.have += data
            return bool(data)
        if self.unpacker.eof:
            return False
        data = self.unpacker.unconsumed_tail or self.file.read(_READ)
        if not data:
            return False
        self.have += self.unpacker.decompress(data, 8 * _READ)
        return True

    def head(self) -> list[str] | None:
        """The lines up to the empty one; None at the end of the file. The line
        ends that close the record before are left out."""
        while True:
            self.have = self.have.lstrip(b"\r\n")
            found = _HEAD_END.search(self.have)
            if found:
                out, self.have = self.have[: found.start()], self.have[found.end() :]
                return re.split("\r?\n", out.decode("utf-8", "replace"))
            if len(self.have) > _MAX_HEAD or self.have and not self.have.startswith(b"WARC/"[: len(self.have)]):
                raise Damage("no record")
            if not self.more():
                if self.have or self.cut():
                    raise Damage("truncated")
                return None

    def cut(self) -> bool:
        """Whether the file ends within the gzip member."""
        return self.unpacker is not None and not self.unpacker.eof

    def take(self, n: int) -> bytes:
        parts, size = [self.have], len(self.have)
        self.have = b""
        while size < n and self.more():
            parts.append(self.have)
            size += len(self.have)
            self.have = b""
        data = b"".join(parts)
        self.have = data[n:]
        return data[:n]

    def skip(self, n: int) -> None:
        """Leave out a payload and go behind the record."""
        if self.unpacker is None:
            self.file.seek(self.file.tell() - len(self.have) + n)
        elif self.length is not None:
            self.file.seek(self.start + self.length)
        else:
            while self.more():
                self.have = b""
            self.end()

    def end(self) -> None:
        """Go behind a record whose payload was taken."""
        if self.unpacker is None:
            self.file.seek(self.file.tell() - len(self.have))
        elif self.length is not None:
            self.file.seek(self.start + self.length)
        else:
            while self.more():
                self.have = b""
            self.file.seek(self.file.tell() - len(self.unpacker.unused_data))


class Damage(ValueError):
    """What is wrong with a record."""


def _next_record(file: BinaryIO, at: int, size: int) -> int:
    """The next place from ``at`` on where a record begins, or the file's size."""
    while at < size:
        file.seek(at)
        window = file.read(_READ + 16)
        for found in _BEGIN.finditer(window):
            place = at + found.start() + (1 if found[0].startswith(b"\n") else 0)
            if found[0].startswith(b"\n"):
                return place
            file.seek(place)
            try:
                if zlib.decompressobj(31).decompress(file.read(_READ), 16).lstrip(b"\r\n").startswith(b"WARC/"):
                    return place
            except zlib.error:
                pass
        at += _READ
    return size


_HEAD_END = re.compile(rb"\r?\n\r?\n")
_BEGIN = re.compile(rb"\nWARC/|\x1f\x8b\x08")


def read_records(
    path: str, wanted, with_payload: bool, stats: dict[str, int] | None = None, mode: str = "fail"
) -> Iterator[dict]:
    """Records of a file whose headers satisfy ``wanted``. Payloads of others are
    passed over unread."""
    with open(path, "rb") as file:
        size = os.fstat(file.fileno()).st_size
        while file.tell() < size:
            at = file.tell()
            if file.read(1) in b"\r\n":  # the end of the record before
                continue
            file.seek(at)
            record: dict[str, Any] = dict.fromkeys(HEADERS) | {"headers": {}, "payload": None, "damage": None}
            try:
                if not _read_record(file, size, record, wanted, with_payload, stats):
                    return
            except (Damage, zlib.error) as e:
                record["damage"] = str(e) if isinstance(e, Damage) else "bad gzip"
                if mode == "fail":
                    raise ValueError(f"{path}: {record['damage']} at {at}") from e
                file.seek(_next_record(file, at + 1, size))
            if wanted(record):
                yield record


_BY_HEADER = {v.lower(): k for k, v in HEADERS.items()}


def _read_record(file: BinaryIO, size: int, record: dict, wanted, with_payload: bool, stats: dict[str, int] | None) -> bool:
    """Fill ``record`` from a file's place and go behind it; False at the file's end."""
    at = file.tell()
    packed = file.read(2) == b"\x1f\x8b"
    file.seek(at)
    source = Unpacked(file, packed)
    lines = source.head()
    if lines is None:
        file.seek(size)
        return False
    if not lines[0].startswith("WARC/"):
        raise Damage("no record")
    length = None
    for line in lines[1:]:
        name, _, value = line.partition(":")
        value = value.strip()
        if name.lower() == "content-length":
            length = value
        elif name.lower() in _BY_HEADER:
            record[_BY_HEADER[name.lower()]] = value
        else:
            record["headers"][name] = value
    if length is None or not re.fullmatch("[0-9]{1,18}", length):
        raise Damage("bad length")
    length = int(length)
    if wanted(record) and with_payload:
        record["payload"] = source.take(length)
        if stats is not None:
            stats["payloads"] = stats.get("payloads", 0) + 1
        if len(record["payload"]) < length:
            raise Damage("truncated")
        if packed:
            rest = source.take(5)
            while len(rest) == 5 and source.more():  # to the checksum
                source.have = b""
            if source.cut():
                raise Damage("truncated")
            if rest.strip(b"\r\n"):
                raise Damage("bad length")
        source.end()
    else:
        source.skip(length)
        if source.cut() and source.length is None:
            raise Damage("truncated")
    if file.tell() > size:
        raise Damage("truncated")
    return True


def http_parts(payload: bytes) -> tuple[int | None, list[tuple[str, str]] | None, bytes]:
    """(status, headers, body) of an HTTP response; (None, None, payload) if it isn't one."""
    found = _HEAD_END.search(payload)
    head = payload[: found.start()] if found else payload
    status, *lines = re.split("\r?\n", head.decode("latin-1"))
    code = re.match(r"HTTP/[0-9.]+ ([0-9]{3})(?: |$)", status)
    if not code:
        return None, None, payload
    headers: dict[str, str] = {}
    for line in lines:
        name, _, value = line.partition(":")
        name = name.strip().lower()
        headers[name] = f"{headers[name]}, {value.strip()}" if name in headers else value.strip()
    return int(code[1]), list(headers.items()), payload[found.end() :] if found else b""


# --- the data source --------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        self.paths = paths


def _test(f: Filter, value: str | None) -> bool:
    if isinstance(f, Not):
        # A comparison with null is neither true nor false.
        inner = f.child
        return not _test(inner, value) if value is not None or isinstance(inner, IsNull | IsNotNull | EqualNullSafe) else False
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None:
        return False
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return value.endswith(f.value)
    return f.value in value


_TESTED = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)


def read_mode(options: dict[str, str]) -> str:
    mode = options.get("mode", "fail").lower()
    if mode not in ("fail", "report"):
        raise ValueError("mode must be fail or report")
    return mode


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], with_payload: bool):
        self.folder = local_path(options["path"])
        self.partition_bytes = int(options.get("partitionbytes", 64_000_000))
        self.with_payload = with_payload
        self.mode = read_mode(options)
        self.http = with_payload and options.get("http", "false") == "true"
        self.filters: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            inner = f.child if isinstance(f, Not) else f
            column = getattr(inner, "attribute", ("",))
            if isinstance(inner, _TESTED) and len(column) == 1 and column[0] in HEADERS:
                self.filters.append((column[0], f))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        found = []
        for folder, _, names in os.walk(self.folder):
            found += [os.path.join(folder, n) for n in names if re.search(r"\.warc(\.gz)?$", n)]
        out, room = [], 0
        for path in sorted(found):
            size = os.path.getsize(path)
            if not out or room < size:
                out.append(Files([]))
                room = self.partition_bytes
            out[-1].paths.append(path)
            room -= size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = dict.fromkeys(HEADERS, pa.string()) | {"headers": pa.map_(pa.string(), pa.string())}
        if self.with_payload:
            kinds["payload"] = pa.binary()
        if self.mode == "report":
            kinds["damage"] = pa.string()
        if self.http:
            kinds |= {"http_status": pa.int32(), "http_headers": kinds["headers"]}

        def batch(rows: list[dict]) -> pa.RecordBatch:
            columns = [[list(r[n].items()) if n == "headers" else r[n] for r in rows] for n in kinds]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds)
            )

        def wanted(record: dict) -> bool:
            return all(_test(f, record[c]) for c, f in self.filters)

        rows, size = [], 0
        for path in partition.paths:
            for record in read_records(path, wanted, self.with_payload, mode=self.mode):
                if self.http:
                    record |= {"http_status": None, "http_headers": None}
                    if (record["content_type"] or "").lower().startswith("application/http") and record["payload"]:
                        record["http_status"], record["http_headers"], record["payload"] = http_parts(record["payload"])
                rows.append(record)
                size += 500 + len(record["payload"] or b"")
                if size >= _BATCH:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.folder = local_path(options["path"])
        self.roll = int(options.get("rollbytes", 64_000_000))
        self.packed = options.get("compression", "gzip") == "gzip"
        if overwrite and os.path.isdir(self.folder) and os.listdir(self.folder):
            raise ValueError(f"{self.folder} is not empty")

    def write(self, iterator: Iterator[Any]) -> Written:
        os.makedirs(self.folder, exist_ok=True)
        names: list[str] = []
        file = None
        try:
            for row in iterator:
                if file is None or file.tell() >= self.roll:
                    if file:
                        file.close()
                    names.append(f"{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                    file = open(os.path.join(self.folder, f"{names[-1]}.part"), "wb")  # noqa: SIM115
                head, payload = record_bytes(row.asDict(True))
                data = b"".join((head, payload, b"\r\n\r\n"))
                file.write(gzip_member(data) if self.packed else data)
        except BaseException:
            for name in names:
                os.remove(os.path.join(self.folder, f"{name}.part"))
            raise
        finally:
            if file:
                file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        for message in messages:
            for name in message.names if message else []:
                path = os.path.join(self.folder, name)
                os.replace(f"{path}.part", path)

    def abort(self, messages: list[Written | None]) -> None:
        for message in messages:
            for name in message.names if message else []:
                os.remove(os.path.join(self.folder, f"{name}.part"))


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        schema = SCHEMA if self._payload() else HEADER_SCHEMA
        if read_mode(dict(self.options)) == "report":
            schema += DAMAGE_SCHEMA
        return schema + (HTTP_SCHEMA if self._payload() and self.options.get("http", "false") == "true" else "")

    def _payload(self) -> bool:
        return self.options.get("payload", "true") != "false"

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options), self._payload())

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- archives with revisits -------------------------------------------------

#: Equal payloads of at least this many bytes are stored once.
MIN_REVISIT_BYTES = 1000
_ID = "urn:page:"


def archive_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_REVISIT_BYTES
) -> DataFrame:
    """WARC records of ``pages``: of equal payloads the one with the largest id is
    a response, and the others revisit it without a payload.

    Equal means equal SHA-1 and length. Only digests that occur more than once
    are joined back. Rows with the largest id themselves repeated are
    responses each; rows without an id are responses unless another has one.
    """
    rows = pages.select(
        F.col(page_id).alias("id"),
        F.col(url).alias("target_uri"),
        F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("bytes"))
    shared = written(
        rows.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first_id is not null")
        .drop("n"),
        "payloads",
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    named = rows.join(shared, ["digest", "bytes"], "left")
    return named.select(
        F.concat(F.lit(_ID), F.col("id").cast("string")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.when(revisit, F.concat(F.lit(_ID), F.col("first_id").cast("string"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.col("bytes").cast("string").alias("payload_bytes"),
        F.lit("text/html").alias("content_type"),
        F.when(revisit, F.create_map(F.lit("WARC-Profile"), F.lit(REVISIT_PROFILE)))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_of(record_id: str) -> Column:
    """The page id in a record id column."""
    return F.substring(F.col(record_id), len(_ID) + 1, 40).try_cast("bigint")


def write_archive(records: DataFrame, folder: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(folder)


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of an
    archive's pages.

    Responses are measured on the payload that is read; revisits are read by
    their headers alone.
    """
    register(spark)
    responses = spark.read.format("warc").load(folder).where("record_type = 'response'")
    revisits = spark.read.format("warc").option("payload", "false").load(folder).where("record_type = 'revisit'")
    return responses.select(
        page_of("record_id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        page_of("refers_to").alias("refers_to"),
    ).unionByName(
        revisits.select(
            page_of("record_id").alias("page_id"),
            F.col("payload_bytes").cast("long").alias("payload_bytes"),
            F.substring("payload_digest", 6, 40).alias("payload_digest"),
            "record_type",
            page_of("refers_to").alias("refers_to"),
        )
    )
