"""Pseudonyms against a plain version, round trips and validity."""

import datetime as dt
import hashlib
import re

from tallyho.llm import pii
from tests.llm.common import edge_documents, edge_rows, no_documents, write_tables

KEY = "a test key"


def f(tag, turn, half):
    return int(hashlib.sha256(f"{KEY}|{tag}|{turn}|{half}".encode()).hexdigest()[:15], 16)


def feistel(left, right, a, b, tag):
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            left = (left + f(tag, i, right)) % a
        else:
            right = (right + f(tag, i, left)) % b
    return left, right


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def refill(m, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in m)


def plain(m):
    digits = re.sub("[^0-9]", "", m)
    if re.fullmatch(pii.IP, m):
        o = [int(x) for x in m.split(".")]
        if max(o) > 255:
            return m
        x, y = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
        return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    if re.fullmatch(pii.ISO_DATE, m) or re.fullmatch(pii.DAY_DATE, m):
        iso = bool(re.fullmatch(pii.ISO_DATE, m))
        try:
            d = dt.date.fromisoformat(m if iso else f"{m[6:]}-{m[3:5]}-{m[:2]}")
        except ValueError:
            return m
        if not 1900 <= d.year <= 2099:
            return m
        first = dt.date(1900, 1, 1)
        x, y = feistel(*divmod((d - first).days, 4297), 17, 4297, "date")
        return refill(m, (first + dt.timedelta(x * 4297 + y)).strftime("%Y%m%d" if iso else "%d%m%Y"))
    if re.fullmatch(pii.SSN, m):
        area, group, serial = int(m[:3]), int(m[4:6]), int(m[7:])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return m
        x, y = feistel((area - 1 - (area > 666)) * 99 + group - 1, serial - 1, 898 * 99, 9999, "ssn")
        at = x // 99
        return f"{at + 1 + (at >= 665):03d}-{x % 99 + 1:02d}-{y + 1:04d}"
    if re.fullmatch(pii.PHONE, m):
        x, y = feistel(int(digits[-10:-5]), int(digits[-5:]), 10**5, 10**5, "phone")
        return refill(m, f"{digits[:-10]}{x:05d}{y:05d}")
    if luhn(digits):
        n = len(digits) - 1
        h = n // 2
        x, y = feistel(int(digits[:h]), int(digits[h:n]), 10**h, 10 ** (n - h), "card")
        body = f"{x:0{h}d}{y:0{n - h}d}"
        return refill(m, next(body + c for c in "0123456789" if luhn(body + c)))
    return m


TEXTS = [
    "card 4539 1488 0343 6467, again 4539148803436467; bad 4539148803436468.",
    "4539-1488-0343-6467 378282246310005 6011111111111117 0000000000000000",
    "call +1 (743) 555-3824 or 743-555-3824 or 1 743 555 3824!!",
    "hosts 10.0.0.1, 255.255.255.255 and 256.1.1.1 v1.2.3.4 1.2.3.4.5 8.8.8.8.",
    "born 1999-12-31 on 31/12/1999 or 31.12.1999, not 1999-02-30 or 1850-01-01 or 2100-01-01; 29.02.2000",
    "ssn 123-45-6789 000-12-3456 666-12-3456 899-99-9999 667-01-0001 665-01-0001",
    'token = "49c25cfcc734f18e8b8637e9c1bf56f794f7f09a" 5500005555555559x x5500005555555559',
    "4539148803436467",
    "4539148803436467 4539148803436467",
    "123456789012345678901234567890 1234",
]


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return sorted(pii.pseudonymise(df, KEY).collect(), key=lambda r: r.row.doc_id)


def there_and_back(spark, texts):
    """(new texts, the texts that they are turned back to)."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    there = pii.pseudonymise(df, KEY).select("row.doc_id", "replaced", "marks", "clean_text")
    rows = sorted(pii.restore(there, KEY).collect(), key=lambda r: r.row.doc_id)
    return [r.row.clean_text for r in rows], [r.restored for r in rows]


def expected(text):
    return re.sub(pii.ANY, lambda m: plain(m[0]), text, flags=re.ASCII) if text else text


def test_equals_plain_version(spark):
    for text, r in zip(TEXTS, run(spark, TEXTS), strict=True):
        assert r.clean_text == expected(text)
        assert r.found == re.findall(pii.ANY, text, flags=re.ASCII)


def test_round_trip_and_links(spark):
    there, back = there_and_back(spark, TEXTS + [None, "", "none"])
    assert back == TEXTS + [None, "", "none"]
    first = re.findall(r"\d[\d ]{14,}\d", there[0])
    assert re.sub(" ", "", first[0]) == first[1] != "4539148803436467"
    assert re.sub("-", "", there[1].split()[0]) == first[1] and luhn(first[1])
    assert "4539148803436468" in there[0] and there[6] == TEXTS[6]


CARD = "4111 1111 1111 1111"
AMONG = [
    "card {} 12/25", "{} 12/25", "{} 123", "no 12 {}", "1234 {}", "no 1234 {} 567 89", "{} 743-555-3824", "{} 12/25/2020",
    "{}, 2024-01-02T10:00:00Z", "12 {} 4242 4242 4242 4242 99", "7 " * 3 + "{}",
]


def test_cards_among_other_digits(spark):
    texts = [x.format(c) for x in AMONG for c in (CARD, "4539 1488 0343 6467", "3782 822463 10005")]
    got, back = there_and_back(spark, texts)
    assert back == texts
    for old, new in zip(texts, got, strict=True):
        assert re.sub("[0-9]", "0", old) == re.sub("[0-9]", "0", new)
        assert not any(c in new for c in (CARD, "4539 1488 0343 6467", "3782 822463 10005", "743-555", "12/25/2020", "2024-01-02")), (old, new)
        assert "4242 4242 4242" not in new
    (alone,) = run(spark, [CARD])
    assert got[0] == f"card {alone.clean_text} 12/25"


def test_one_pseudonym_whatever_stands_beside(spark):
    """All three-digit followers, other neighbours, and all groupings of a card."""
    (alone,) = run(spark, [CARD])
    new = re.sub(" ", "", alone.clean_text)
    after = [f"card {CARD} {k:03d}" for k in range(1000)]
    assert [r.clean_text for r in run(spark, after)] == [f"card {alone.clean_text} {k:03d}" for k in range(1000)]
    spelled = [CARD.replace(" ", "-"), CARD.replace(" ", ""), f"({CARD})", f"{CARD}, 7 12", f"no 5: {CARD}"]
    for r in run(spark, spelled):
        assert new in re.sub("[^0-9]", "", r.clean_text)
    # Many cards in one run: each is what it is alone.
    cards = [CARD, "4539 1488 0343 6467", "5500 0000 0000 0004", "6011 0000 0000 0004", "4242 4242 4242 4242", "4012 8888 8888 1881"]
    one_by_one = [r.clean_text for r in run(spark, cards)]
    (together,) = run(spark, ["; ".join(cards)])
    assert together.clean_text == "; ".join(one_by_one)


def test_one_pseudonym_however_a_date_is_written(spark):
    days = [dt.date(2020, 12, 1) + dt.timedelta(k) for k in range(31)]
    got = run(spark, [f"{d:%Y-%m-%d} {d:%d/%m/%Y} {d:%d.%m.%Y} {d:%m/%d/%Y}" for d in days])
    for day, r in zip(days, got, strict=True):
        iso, slash, point, month = r.clean_text.split()
        new = dt.date.fromisoformat(iso)
        assert new != day and slash == f"{new:%d/%m/%Y}" and point == f"{new:%d.%m.%Y}"
        if day.day > 12:  # else it is read day first
            assert month == (f"{new:%m/%d/%Y}" if new.day > 12 else f"{new:%d/%m/%Y}")


def test_long_runs_of_numbers(spark):
    texts = [" ".join(["1200"] * 4 + [CARD] + ["1200"] * 30_000), "12 " * 20_000, "7" * 50_000, "1-" * 3_000 + "1"]
    got = [r.clean_text for r in run(spark, texts)]
    assert CARD not in got[0] and [len(x) for x in got] == [len(x) for x in texts]


def test_month_first_dates_and_times(spark):
    days = [dt.date(1999, 1, 1) + dt.timedelta(k) for k in range(0, 800, 3)]
    texts = [f"{d:%m/%d/%Y}" for d in days if d.day > 12]
    got, back = there_and_back(spark, texts)
    assert back == texts and len(set(got)) == len(texts) and not set(got) & set(texts)
    odd = ["31/31/2020 02/30/2020 12/25/1850", "2024-01-02Tuesday x2024-01-02T10", "2024-13-02T10"]
    assert [r.clean_text for r in run(spark, odd)] == odd
    time, day = run(spark, ["at 2024-01-02T10:00:00Z", "at 2024-01-02"])
    assert time.clean_text == day.clean_text + "T10:00:00Z" != "at 2024-01-02T10:00:00Z"


def test_permutation_has_no_collisions(spark):
    days = [(dt.date(1900, 1, 1) + dt.timedelta(k)).isoformat() for k in range(0, 73049, 7)]
    got = [r.clean_text for r in run(spark, days)]
    assert len(set(got)) == len(days) and all(dt.date.fromisoformat(x) for x in got)
    ips = [f"{k % 256}.{k // 256 % 256}.7.{k % 251}" for k in range(3000)]
    assert len({r.clean_text for r in run(spark, ips)}) == len(set(ips))


def test_edges_and_whole_table(spark, tmp_dir):
    from tallyho.llm.queries import op10_pii_pseudonyms

    docs = edge_documents(spark, extra=True)
    got = pii.pseudonymise(docs, KEY).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.row.doc_id, r.clean_text) for r in got), key=key) == sorted(
        ((r[0], r[1]) for r in edge_rows()), key=key
    )
    assert set(docs.columns) == set(got[0].row.asDict())
    assert op10_pii_pseudonyms(spark, write_tables(spark, tmp_dir, no_documents(spark))).collect() == []


def test_query_on_table(spark):
    from tallyho.llm import queries
    from tests.conftest import SF_SMALL

    global KEY
    old, KEY = KEY, queries.DEMO_KEY
    try:
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
        got = queries.op10_pii_pseudonyms(spark, SF_SMALL).collect()
        assert len(got) == len(texts) and sum(r.n_replaced for r in got) > 5
        for r in got:
            assert r.clean_text == expected(texts[r.doc_id])
    finally:
        KEY = old
