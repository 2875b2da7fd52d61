"""Operator 10, format-preserving Feistel pseudonyms, in DataFrame functions.

Card numbers, phone numbers, social security numbers, IPv4 addresses and dates
are found in whole texts, validated (Luhn check, ranges, calendar), and each
is replaced by another valid value of the same format: a keyed permutation of
all values of the format. The pseudonym depends on the value and the key alone:
equal values get equal ones in every document, whatever stands beside them and
however they are punctuated (or, dates, in which order they are written), and
different values get different ones. Numbers that don't validate stay.

A value is a pair (left, right) with ``left < a`` and ``right < b``. Feistel rounds in
turn add a keyed SHA-256 of one half to the other, modulo ``a`` or ``b``, which is a
permutation of all pairs for any ``a`` and ``b``. So every format is permuted on
exactly its valid values:

* card: the digits before the check digit, cut in halves; the check digit is
  computed anew. 13 to 19 digits, alone or with single spaces or dashes, also
  among other digit groups;
* phone: ten digits, cut in halves (area code and number, country code kept);
* social security number: area and group, serial; only assignable ones;
* IPv4: the two upper and the two lower octets;
* date: the days from 1900 to 2099, as 17 times 4297. Day first, or month first
  where only that is a calendar day; a month-first date whose pseudonym would be
  read day first is written day first. An ISO date may begin a time.

Who has the key can turn the values back (:func:`restore`), from the kinds and places that
``marks`` notes; the text alone may be read otherwise, since the new digits beside others
may look like another card.

All is per-text work in the JVM; nothing is shuffled. The key is an argument;
keep the real one out of the code.

Defined results: a null text stays null and has no matches; texts without matches are
unchanged. A match is the longest run that a format fits, from left to right;
digits that touch letters, digits or points of a longer token are no match. In
a run of digit groups the cards are the sub-runs of whole groups that pass the
Luhn check and don't overlap: first those grouped as cards are, of those the
shorter (a card's three-digit code may follow it), then the other ones, of those the
longer, then the earlier. Runs of over 200 numbers are read in parts of 200. Texts of any
length are read whole; one text, its matches and its new copy must fit in a task.
Repeated rows get equal results. The input's columns come back in one struct,
``row``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import with_row

ROUNDS = 10

# The formats, in the order in which they are tried.
IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DAY_DATE = r"[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
END = r"(?![\w@]|[.-]\w)"
ISO_START = rf"{ISO_DATE}(?:{END}|(?=T[0-9]))"
_OTHERS = rf"(?:{ISO_START}|(?:{IP}|{DAY_DATE}|{SSN}|{PHONE}){END})"
_BREAK = rf"(?:-| (?!{_OTHERS}))"  # within a run; another format's value ends it
_RUN = rf"[0-9](?:{_BREAK}?[0-9]){{12,18}}"
_LONG = rf"(?![0-9]{{13}})[0-9](?:(?:{_BREAK}(?![0-9]{{13}}))?[0-9]){{12,60}}{END}"
_NUMBER = rf"[0-9]{{1,12}}+(?:-[0-9]{{1,12}}+)*+{END}"
#: Up to 19 digits that no more follow; else numbers in groups of up to 12
#: digits, 13 digits at least; else up to 19 digits. (Java's matcher recurses in
#: repeated groups that aren't possessive.)
CARD = rf"(?:{_RUN}(?![ -]?[0-9])|(?={_LONG}){_NUMBER}(?: (?!{_OTHERS}){_NUMBER}){{0,199}}+|{_RUN})"
FORMATS = {"ip": IP, "iso_date": ISO_DATE, "day_date": DAY_DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = rf"(?<![\w.@+-])(?:{ISO_START}|(?:{IP}|{DAY_DATE}|{SSN}|{PHONE}|{CARD}){END})"
#: Lengths of the groups that cards are written in, besides one group.
GROUPINGS = ("4-4-4-4", "4-6-5", "4-4-4-4-3")

_FIRST_DAY, _LAST_DAY = "1900-01-01", "2099-12-31"
_DAYS_A, _DAYS_B = 17, 4297  # 73,049 days


def _keyed(key: str, tag: str, half: Column, turn: Column) -> Column:
    """60 bits of SHA-256 over key, format, round and half."""
    text = F.concat_ws("|", F.lit(key), F.lit(tag), turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tag: str, back: bool = False) -> Column:
    """struct(l, r): the keyed permutation of (left, right); ``back`` inverts it."""
    a, b = a.cast("long"), b.cast("long")
    turns = list(range(ROUNDS))
    sign = -1 if back else 1

    def turn(s: Column, i: Column) -> Column:
        to_left = F.struct(F.pmod(s["l"] + sign * F.pmod(_keyed(key, tag, s["r"], i), a), a).alias("l"), s["r"].alias("r"))
        to_right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + sign * F.pmod(_keyed(key, tag, s["l"], i), b), b).alias("r"))
        return F.when(i % 2 == 0, to_left).otherwise(to_right)

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*(F.lit(i) for i in (reversed(turns) if back else turns))), start, turn)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _padded(x: Column, width: Column) -> Column:
    return F.lpad(x.cast("string"), width, F.lit("0"))


def _refilled(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order, its punctuation kept."""

    def char(i: Column) -> Column:
        c = F.substring(m, i, F.lit(1))
        at = F.length(_digits(F.substring(m, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, at, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), char), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def luhn_sum(digits: Column, even_first: Column) -> Column:
    """Luhn sum of a digit string; the digits at places of one parity from the
    right are doubled, those at the last place if ``even_first``."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = ((n - i) % 2 == 0) == even_first
        return F.when(doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda s, d: s + d)


def _cards(digits: Column, borders: Column) -> Column:
    """(at, n) of the sub-runs between borders that are cards, by place."""
    last = F.size(borders) - 1

    def passing(i: Column) -> Column:
        at = F.get(borders, i)
        ends = F.transform(F.sequence(i + 1, F.least(last, i + 19)), lambda j: F.struct(j.alias("j"), (F.get(borders, j) - at).alias("n")))
        luhn = lambda n: luhn_sum(F.substring(digits, at + 1, n), F.lit(False)) % 10 == 0
        fits = F.filter(ends, lambda e: F.when((e["n"] >= 13) & (e["n"] <= 19), luhn(e["n"])).otherwise(False))

        def ranked(e: Column) -> Column:
            lengths = F.transform(F.sequence(i, e["j"] - 1), lambda k: F.get(borders, k + 1) - F.get(borders, k))
            usual = (e["j"] == i + 1) | F.array_join(lengths.cast("array<string>"), "-").isin(*GROUPINGS)
            length = F.when(usual, e["n"]).otherwise(-e["n"])
            return F.struct((~usual).alias("odd"), length.alias("length"), at.alias("at"), e["n"].alias("n"))

        return F.transform(fits, ranked)

    def take(cards: Column, c: Column) -> Column:
        apart = F.forall(cards, lambda o: (o["at"] >= c["at"] + c["n"]) | (c["at"] >= o["at"] + o["n"]))
        return F.when(apart, F.concat(cards, F.array(F.struct(c["at"].alias("at"), c["n"].alias("n"))))).otherwise(cards)

    found = F.flatten(F.transform(F.sequence(F.lit(0), last - 1), passing))
    none = F.array().cast("array<struct<at:int,n:int>>")
    return F.array_sort(F.aggregate(F.array_sort(found), none, take))


_NO_CARDS = "array<struct<at:int,n:int>>"


def _found_cards(m: Column) -> Column:
    """(at, n) of the cards among a run's digits."""
    groups = F.split(m, "[ -]")
    ends = lambda g: F.transform(F.sequence(F.lit(0), F.size(g)), lambda i: F.length(F.array_join(F.slice(g, F.lit(1), i), "")))
    return _let(F.struct(_digits(m).alias("digits"), _let(groups, ends).alias("borders")), lambda x: _cards(x["digits"], x["borders"]))


def _card(m: Column, cards: Column, key: str, back: bool) -> Column:
    """A run with each of its cards replaced."""

    def swap(d: Column) -> Column:
        width = F.length(d) - 1
        half = F.floor(width / 2).cast("int")
        a, b = F.pow(F.lit(10.0), half).cast("long"), F.pow(F.lit(10.0), width - half).cast("long")
        left, right = F.substring(d, F.lit(1), half), F.substring(d, half + 1, width - half)
        moved = feistel(left.cast("long"), right.cast("long"), a, b, key, "card", back)
        body = _let(moved, lambda s: F.concat(_padded(s["l"], half), _padded(s["r"], width - half)))
        return _let(body, lambda x: F.concat(x, ((10 - luhn_sum(x, F.lit(True)) % 10) % 10).cast("string")))

    def put(all_: Column, c: Column) -> Column:
        past = c["at"] + c["n"]
        new = _let(F.substring(all_, c["at"] + 1, c["n"]), swap)
        return F.concat(F.substring(all_, F.lit(1), c["at"]), new, F.substring(all_, past + 1, F.length(all_) - past))

    return _refilled(m, F.aggregate(cards, _digits(m), put))


def _phone(m: Column, key: str, back: bool) -> Column:
    def swap(d: Column) -> Column:
        n = F.length(d)
        kept, ten = F.substring(d, F.lit(1), n - 10), F.substring(d, n - 9, F.lit(10))
        moved = feistel(
            F.substring(ten, 1, 5).cast("long"), F.substring(ten, 6, 5).cast("long"), F.lit(10**5), F.lit(10**5), key, "phone", back
        )
        return _refilled(m, F.concat(kept, _let(moved, lambda s: F.concat(_padded(s["l"], F.lit(5)), _padded(s["r"], F.lit(5))))))

    return _let(_digits(m), swap)


def _ssn_parts(m: Column) -> tuple[Column, Column, Column]:
    return tuple(F.substring(m, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))


def _ssn_valid(m: Column) -> Column:
    area, group, serial = _ssn_parts(m)
    return (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)


def _ssn(m: Column, key: str, back: bool) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = _ssn_parts(m)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    moved = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", back)

    def text(s: Column) -> Column:
        at = F.floor(s["l"] / 99)
        new_area = F.when(at >= 665, at + 2).otherwise(at + 1)
        return F.concat_ws(
            "-", _padded(new_area, F.lit(3)), _padded(s["l"] % 99 + 1, F.lit(2)), _padded(s["r"] + 1, F.lit(4))
        )

    return _let(moved, text)


def _ip(m: Column, key: str, back: bool) -> Column:
    def swap(o: Column) -> Column:
        moved = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip", back)
        octets = lambda x: (F.floor(x / 256).cast("string"), (x % 256).cast("string"))
        return _let(moved, lambda s: F.concat_ws(".", *octets(s["l"]), *octets(s["r"])))

    return _let(F.split(m, r"\.").cast("array<int>"), swap)


def _day(m: Column, day: int, month: int) -> Column:
    return F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, month, 2), F.substring(m, day, 2)).try_cast("date")


_IN_ORDER: dict[str, Callable[[Column], Column]] = {
    "iso_date": lambda m: m.try_cast("date"),
    "day_date": lambda m: _day(m, 1, 4),
    # Written month first only where that alone is a day.
    "month_date": lambda m: F.coalesce(_day(m, 1, 4), _day(m, 4, 1)),
}


def _date_valid(d: Column) -> Column:
    return d.between(F.lit(_FIRST_DAY).cast("date"), F.lit(_LAST_DAY).cast("date"))


def _date(m: Column, kind: str, key: str, back: bool) -> Column:
    first = F.lit(_FIRST_DAY).cast("date")

    def moved(day: Column) -> Column:
        new = feistel(F.floor(day / _DAYS_B), day % _DAYS_B, F.lit(_DAYS_A), F.lit(_DAYS_B), key, "date", back)
        return _let(new, lambda s: F.date_add(first, (s["l"] * _DAYS_B + s["r"]).cast("int")))

    def written(d: Column) -> Column:
        if kind == "iso_date":
            return F.date_format(d, "yyyyMMdd")
        month_first = F.lit(kind == "month_date") & (F.lit(back) | (F.dayofmonth(d) > 12))
        return F.when(month_first, F.date_format(d, "MMddyyyy")).otherwise(F.date_format(d, "ddMMyyyy"))

    day = F.datediff(_IN_ORDER[kind](m), first)
    return _let(_let(day, moved), lambda d: _refilled(m, written(d)))


def reading(m: Column) -> Column:
    """struct(kind, cards): the format that a match is valid in (null: none) and, in a run
    of digit groups, the cards' places among its digits."""
    fits = lambda name: m.rlike(f"^(?:{FORMATS[name]})$")
    octets = F.split(m, r"\.").cast("array<int>")
    none = F.array().cast(_NO_CARDS)
    cards = F.when(
        ~(fits("ip") | fits("iso_date") | fits("day_date") | fits("ssn") | fits("phone")), _found_cards(m)
    ).otherwise(none)

    def kind(found: Column) -> Column:
        dated = F.when(_date_valid(_day(m, 1, 4)), "day_date").when(
            _day(m, 1, 4).isNull() & _date_valid(_day(m, 4, 1)), "month_date"
        )
        return (
            F.when(fits("ip"), F.when(F.array_max(octets) < 256, "ip"))
            .when(fits("iso_date"), F.when(_date_valid(m.try_cast("date")), "iso_date"))
            .when(fits("day_date"), dated)
            .when(fits("ssn"), F.when(_ssn_valid(m), "ssn"))
            .when(fits("phone"), "phone")
            .when(F.size(found) > 0, "card")
        )

    return _let(cards, lambda c: F.struct(kind(c).alias("kind"), c.alias("cards")))


def moved(m: Column, read: Column, key: str, back: bool = False) -> Column:
    """What stands for a match that was read as ``read``; ``back``: the match that a
    pseudonym stands for."""
    kind = read["kind"]
    out = F.when(kind == "ip", _ip(m, key, back)).when(kind == "ssn", _ssn(m, key, back)).when(kind == "phone", _phone(m, key, back))
    for date in _IN_ORDER:
        out = out.when(kind == date, _date(m, date, key, back))
    return out.when(kind == "card", _card(m, read["cards"], key, back)).otherwise(m)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` as struct ``row`` with (found, replaced, marks, clean_text): the matches, what
    stands for each, what :func:`restore` needs of each (the characters before it since
    the last one, its kind and its cards), and the whole text with the pseudonyms in
    place."""
    whole = F.col(f"row.{text}")
    found = with_row(docs).withColumn("found", F.coalesce(F.regexp_extract_all(whole, F.lit(ANY), F.lit(0)), F.array()))
    read = found.withColumn("read", F.transform("found", reading))
    swapped = read.withColumn("replaced", F.zip_with("found", "read", lambda m, r: moved(m, r, key)))
    between = F.split(whole, ANY, -1)
    pieces = F.zip_with(between, F.col("replaced"), lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
    marks = F.zip_with(
        F.slice(between, F.lit(1), F.size("found")),
        F.col("read"),
        lambda p, r: F.struct(F.length(p).alias("gap"), r["kind"].alias("kind"), r["cards"].alias("cards")),
    )
    return swapped.select(
        "row",
        "found",
        "replaced",
        F.coalesce(marks, F.array().cast(_MARKS)).alias("marks"),
        F.when(F.size("found") > 0, F.array_join(pieces, "")).otherwise(whole).alias("clean_text"),
    )


_MARKS = f"array<struct<gap:int,kind:string,cards:{_NO_CARDS}>>"


def restore(docs: DataFrame, key: str, text: str = "clean_text", marks: str = "marks", replaced: str = "replaced") -> DataFrame:
    """``docs`` as struct ``row`` with ``restored``: the text with the values that its pseudonyms
    stand for, from the columns of :func:`pseudonymise`. Its work grows with the square of a
    text's matches."""
    whole, new = F.col(f"row.{text}"), F.col(f"row.{replaced}")
    both = F.zip_with(F.col(f"row.{marks}"), new, lambda k, r: F.struct(k["gap"].alias("gap"), F.length(r).alias("n"), moved(r, k, key, True).alias("old")))

    def step(s: Column, x: Column) -> Column:
        piece = F.concat(F.substring(whole, s["at"], x["gap"]), x["old"])
        return F.struct((s["at"] + x["gap"] + x["n"]).alias("at"), F.concat(s["out"], F.array(piece)).alias("out"))

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("out"))
    built = F.aggregate(both, start, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(whole, s["at"], F.length(whole))))
    return with_row(docs).withColumn("restored", F.when(whole.isNotNull(), built))
