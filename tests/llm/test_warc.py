"""WARC round trips, push-down and skipping."""

import gzip
import hashlib
import os
import random

import pytest

from tallyho.llm import warc
from tests.conftest import SF_SMALL
from tests.llm.common import write_tables

PAGES = "page_id bigint, url string, html string"


def archive(spark, rows, folder, **options):
    warc.register(spark)
    df = spark.createDataFrame(rows, warc.SCHEMA)
    df.write.format("warc").options(**options).mode("append").save(folder)


def record(i, payload, kind="response", **more):
    base = dict.fromkeys(warc.HEADERS)
    base |= {"record_id": f"urn:page:{i}", "record_type": kind, "headers": {"X-Own": f"é {i}"}, "payload": payload}
    return tuple((base | more)[c] for c in [*warc.HEADERS, "headers", "payload"])


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_dir, compression):
    r = random.Random(4)
    payloads = [b"", b"\r\n\r\nWARC/1.1\r\n\r\n", bytes(range(256)) * 3, r.randbytes(700_000), None]
    rows = [record(i, p, target_uri=f"http://h/{i}") for i, p in enumerate(payloads * 4)]
    archive(spark, rows, tmp_dir, compression=compression, rollBytes="600000")
    back = spark.read.format("warc").option("partitionBytes", "1").load(tmp_dir)
    got = {x.record_id: x for x in back.collect()}
    assert len(got) == len(rows)
    for i, p in enumerate(payloads * 4):
        x = got[f"urn:page:{i}"]
        assert bytes(x.payload) == (p or b"") and x.headers == {"X-Own": f"é {i}"} and x.target_uri == f"http://h/{i}"
        assert x.refers_to is None
    assert not [n for n in os.listdir(tmp_dir) if n.endswith(".part")]
    if compression == "gzip":
        path = next(os.path.join(tmp_dir, n) for n in os.listdir(tmp_dir) if n.endswith(".gz"))
        with gzip.open(path) as f:  # any reader of gzip can read the members
            assert f.read().startswith(b"WARC/1.1\r\n")


def test_filters_are_pushed_and_payloads_skipped(spark, tmp_dir):
    rows = [
        record(i, b"x" * 5000, ["response", "revisit", "request"][i % 3], target_uri=f"http://{'ab'[i % 2]}/{i}")
        for i in range(60)
    ] + [record(99, b"", "metadata")]
    archive(spark, rows, tmp_dir)
    load = lambda: spark.read.format("warc").load(tmp_dir)
    picked = load().where("record_type = 'response' and target_uri like 'http://a%' and length(payload) > 10")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "record_type" not in plan.split("Filter", 1)[1].split("\n")[0]
    assert picked.count() == sum(i % 3 == 0 and i % 2 == 0 for i in range(60))
    assert load().where("record_type <> 'response'").count() == 41
    assert load().where("target_uri is null").count() == 1
    assert load().where("not target_uri = 'http://a/0'").count() == 59
    assert load().where("record_type in ('request', 'metadata') or record_id = 'urn:page:0'").count() == 22
    bare = spark.read.format("warc").option("payload", "false").load(tmp_dir)
    assert "payload" not in bare.columns and bare.count() == 61
    # The reader itself: only wanted payloads are unpacked, others not read.
    stats, read = {}, []
    real = warc.zlib.decompressobj

    class Counted:
        def __init__(self, *a):
            self.inner = real(*a)

        def decompress(self, data, n=0):
            out = self.inner.decompress(data, n)
            read.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.inner, name)

    warc.zlib.decompressobj = Counted
    try:
        for path in [os.path.join(tmp_dir, n) for n in os.listdir(tmp_dir) if n.endswith(".gz")]:
            list(warc.read_records(path, lambda r: r["record_type"] == "request", True, stats))
    finally:
        warc.zlib.decompressobj = real
    assert stats["payloads"] == 20


def test_foreign_members_without_length(tmp_path):
    path = tmp_path / "x.warc.gz"
    parts = [b"".join([*warc.record_bytes({"record_id": str(i), "payload": b"y" * (200_000 * i)}), b"\r\n\r\n"]) for i in range(4)]
    path.write_bytes(b"".join(gzip.compress(p) for p in parts))
    got = list(warc.read_records(str(path), lambda r: r["record_id"] != "2", True))
    assert [(r["record_id"], len(r["payload"])) for r in got] == [("0", 0), ("1", 200_000), ("3", 600_000)]
    bare = list(warc.read_records(str(path), lambda r: True, False))
    assert [r["record_id"] for r in bare] == ["0", "1", "2", "3"]


def test_empty_folder(spark, tmp_dir):
    warc.register(spark)
    assert spark.read.format("warc").load(tmp_dir).count() == 0


def expected(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            first[p] = max(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        other = first.get(p)
        revisit = other is not None and other != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return sorted(out, key=str)


def test_query(spark, tmp_dir):
    from tallyho.llm.queries import op6_warc

    long_a, long_b = "ä" * 500, "b" * 1000
    rows = [(1, "u", long_a), (2, None, long_a), (3, "u", long_b), (9, "u", long_b), (4, "u", long_b)]
    rows += [(5, "u", "c" * 999), (6, "u", "c" * 999), (7, "u", None), (8, "u", ""), (9, "u", long_b), (None, "u", long_a)]
    rows += [(10, "line\r\nbreak", "x\r\n\r\nWARC/1.0\r\n" * 90)]
    folder = write_tables(spark, tmp_dir, spark.createDataFrame([], "doc_id bigint"), pages=spark.createDataFrame(rows, PAGES))
    got = op6_warc(spark, folder)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
    real = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, op6_warc(spark, SF_SMALL).collect()), key=str) == expected(real)


def test_query_on_empty_table(spark, tmp_dir):
    from tallyho.llm.queries import op6_warc

    folder = write_tables(spark, tmp_dir, spark.createDataFrame([], "doc_id bigint"), pages=spark.createDataFrame([], PAGES))
    assert op6_warc(spark, folder).collect() == []


def plain_record(i, payload, end="\r\n", length=None, kind="application/http"):
    lines = ["WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: {i}", f"Content-Type: {kind}"]
    lines += [f"Content-Length: {len(payload) if length is None else length}"]
    return (end.join(lines) + end * 2).encode() + payload + (end * 2).encode()


def read(path, mode="report", with_payload=True):
    rows = warc.read_records(str(path), lambda r: True, with_payload, mode=mode)
    return [(r["record_id"], len(r["payload"]) if r["payload"] is not None else None, r["damage"]) for r in rows]


def noise(n, seed=1):
    return random.Random(seed).randbytes(n)


@pytest.mark.parametrize("packed", [False, True])
def test_line_feeds_alone(tmp_path, packed):
    path = tmp_path / "x.warc"
    parts = [plain_record(i, b"a\n\nb\r\n\r\nc" * i, "\n") for i in range(5)]
    path.write_bytes(b"".join(gzip.compress(p) if packed else p for p in parts))
    assert read(path, "fail") == [(str(i), 9 * i, None) for i in range(5)]
    assert [x[0] for x in read(path, "fail", False)] == list("01234")


@pytest.mark.parametrize("own", [False, True])
def test_cut_gzip_file(tmp_path, own):
    path = tmp_path / "x.warc.gz"
    pack = warc.gzip_member if own else gzip.compress
    data = b"".join(pack(plain_record(i, noise(3500, i))) for i in range(5))
    for cut in (1, 9, 40, 1000, 3400):
        path.write_bytes(data[:-cut])
        got = read(path)
        assert [x[0] for x in got[:4]] == list("0123") and len(got) == 5
        assert got[4][2] == "truncated" and all(x[2] is None for x in got[:4])
        with pytest.raises(ValueError, match="truncated at"):
            read(path, "fail")
        assert read(path, with_payload=False)[4][2] == "truncated"


def test_cut_plain_file(tmp_path):
    path = tmp_path / "x.warc"
    data = b"".join(plain_record(i, noise(3500, i)) for i in range(3))
    path.write_bytes(data[:-1004])
    assert read(path) == [("0", 3500, None), ("1", 3500, None), ("2", 2500, "truncated")]
    assert read(path, with_payload=False)[2] == ("2", None, "truncated")
    with pytest.raises(ValueError, match="truncated at"):
        read(path, "fail")
    path.write_bytes(data[: 2 * len(data) // 3 + 20])  # within the headers
    assert read(path)[2] == (None, None, "truncated")


def test_bad_bytes_are_passed_over(tmp_path):
    """Reading goes on with the next record."""
    path = tmp_path / "x.warc.gz"
    members = [gzip.compress(plain_record(i, noise(3500, i))) for i in range(4)]
    for place, bad in ((1800, members[1][:1800] + b"\xff\xff" + members[1][1802:]), (0, b"not gzip" * 20)):
        path.write_bytes(b"".join([members[0], bad, *members[2:]]))
        got = read(path)
        assert [x[0] for x in got if x[2] is None] == ["0", "2", "3"], place
        assert len(got) == 4 and got[1][2] in ("bad gzip", "no record", "bad length")
        with pytest.raises(ValueError, match=f"at {len(members[0])}"):
            read(path, "fail")
    plain = [plain_record(i, b"x" * 50) for i in range(3)]
    plain[1] = b"garbage" + plain[1][7:]
    (tmp_path / "y.warc").write_bytes(b"".join(plain))
    assert [x[0] for x in read(tmp_path / "y.warc") if x[2] is None] == ["0", "2"]


@pytest.mark.parametrize("length", ["x", "-1", "", "10", "99"])
@pytest.mark.parametrize("packed", [False, True])
def test_wrong_lengths(tmp_path, length, packed):
    path = tmp_path / "x.warc"
    parts = [plain_record(0, b"a" * 50), plain_record(1, b"b" * 50, length=length), plain_record(2, b"c" * 50)]
    path.write_bytes(b"".join(gzip.compress(p) if packed else p for p in parts))
    got = read(path)
    assert got[0] == ("0", 50, None) and any(x[2] for x in got[1:])
    if packed:
        assert got[2] == ("2", 50, None) and len(got) == 3
    with pytest.raises(ValueError, match="at"):
        read(path, "fail")


def test_long_members_have_no_length(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_SL_LIMIT", 2000)
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(warc.gzip_member(plain_record(i, b"y" * n)) for i, n in enumerate((10, 5000, 20))))
    assert read(path, "fail") == [("0", 10, None), ("1", 5000, None), ("2", 20, None)]
    assert [x[0] for x in read(path, "fail", False)] == list("012")


def test_report_and_http_columns(spark, tmp_dir):
    answer = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\nSet-Cookie: a\r\nSet-Cookie: b\r\n\r\n<p>\r\n\r\nx"
    parts = [
        plain_record(0, answer), plain_record(1, b"HTTP/1.0 200 OK\n\nbody"), plain_record(2, b"no status\r\n\r\nx"),
        plain_record(3, answer, kind="text/plain"), plain_record(4, b"z" * 9, length="q"), plain_record(5, b""),
    ]
    with open(os.path.join(tmp_dir, "x.warc.gz"), "wb") as f:
        f.write(b"".join(map(gzip.compress, parts)))
    warc.register(spark)
    load = spark.read.format("warc").option("mode", "report").option("http", "true").load(tmp_dir)
    got = {r.record_id: r for r in load.collect()}
    assert (got["0"].http_status, bytes(got["0"].payload)) == (404, b"<p>\r\n\r\nx")
    assert got["0"].http_headers == {"content-type": "text/html", "set-cookie": "a, b"}
    assert (got["1"].http_status, bytes(got["1"].payload)) == (200, b"body")
    assert got["2"].http_status is None and bytes(got["2"].payload) == b"no status\r\n\r\nx"
    assert got["3"].http_status is None and bytes(got["3"].payload) == answer
    assert got["4"].damage == "bad length" and {k for k, r in got.items() if r.damage} == {"4"}
    with pytest.raises(Exception, match="bad length"):
        spark.read.format("warc").load(tmp_dir).collect()
