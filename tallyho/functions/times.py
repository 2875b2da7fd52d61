"""Time expressions: stamps, 15-minute slots, segment names, epoch arithmetic.

All arithmetic is on epoch microseconds with built-in functions, so results
do not depend on the session time zone except where text is parsed or
formatted; :func:`tallyho.session.configure` pins the session to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feed publishes one segment every 15 minutes, named
# yyyyMMddHHmm00 plus this extension, in UTC.
SLOT_MINUTES = 15
SEGMENT_EXTENSION = ".gkg.csv"
SEGMENT_STAMP_FORMAT = "yyyyMMddHHmm'00'"
STAMP_FORMAT = "yyyyMMddHHmmss"

_MICROS_PER_MINUTE = 60_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_instant(ts: Column | str) -> Column:
    """``timestamp_ntz`` (as stored in the tables) -> ``timestamp`` (UTC)."""
    return _col(ts).cast("timestamp")


def day_of_stamp(stamp: Column | str) -> Column:
    """Calendar day of a 14-digit stamp; null when the text is no date."""
    return F.to_date(F.try_to_timestamp(F.substring(_col(stamp), 1, 8), F.lit("yyyyMMdd")))


def stamp_instant(stamp: Column | str) -> Column:
    """14-digit stamp -> instant, seconds dropped (minute precision)."""
    return F.try_to_timestamp(F.substring(_col(stamp), 1, 12), F.lit("yyyyMMddHHmm"))


def stamp_of(ts: Column | str) -> Column:
    """Instant -> 14-digit ``yyyyMMddHHmmss`` text."""
    return F.date_format(_col(ts), STAMP_FORMAT)


def slot_start(ts: Column | str, minutes: int = SLOT_MINUTES) -> Column:
    """Floor an instant to its slot (epoch-aligned, like ``window().start``)."""
    micros = F.unix_micros(_col(ts))
    width = F.lit(minutes * _MICROS_PER_MINUTE)
    return F.timestamp_micros(micros - F.pmod(micros, width))


def slot_end(ts: Column | str, minutes: int = SLOT_MINUTES) -> Column:
    """The next slot boundary after an instant (end of its current slot).

    10:15:00 -> 10:30, 23:59:59 -> 00:00 the next day.
    """
    micros = F.unix_micros(_col(ts))
    width = F.lit(minutes * _MICROS_PER_MINUTE)
    return F.timestamp_micros(micros - F.pmod(micros, width) + width)


def segment_name(slot: Column | str) -> Column:
    """Slot start -> segment file name ``yyyyMMddHHmm00.gkg.csv``."""
    return F.concat(F.date_format(_col(slot), SEGMENT_STAMP_FORMAT), F.lit(SEGMENT_EXTENSION))


def millis_instant(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))
