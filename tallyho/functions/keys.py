"""Record ids ``<yyyyMMddHHmmss>-<sequence>`` and raw-line fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import stamp_of

# Fixed value: the key assumed before anything was published.
DEFAULT_LAST_KEY = "20150218230000-0"

_LONG_TEXT = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_key(ts: Column | str, seq: Column | str) -> Column:
    """Instant and sequence number -> ``yyyyMMddHHmmss-seq``."""
    return F.concat(stamp_of(ts), F.lit("-"), _col(seq).cast("string"))


def parse_record_key(key: Column | str) -> Column:
    """``ts-seq`` -> struct(key_ts long, key_seq long); (0, 0) if malformed.

    Dashes at the end don't count (``1-2-`` is ``1-2``). Exactly two parts,
    both whole numbers that fit a long; anything else (``x-1``, ``1-2-3``, ``5-``)
    gives (0, 0).
    """
    parts = F.split(F.regexp_replace(_col(key), "-+$", ""), "-", -1)
    a = F.get(parts, 0)
    b = F.get(parts, 1)
    ok = (
        (F.size(parts) == 2)
        & a.rlike(_LONG_TEXT)
        & b.rlike(_LONG_TEXT)
        & a.try_cast("bigint").isNotNull()
        & b.try_cast("bigint").isNotNull()
    )
    ok = F.coalesce(ok, F.lit(False))
    return F.struct(
        F.when(ok, a.try_cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("key_ts"),
        F.when(ok, b.try_cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("key_seq"),
    )


def first_field(line: Column | str, sep: str = "\t") -> Column:
    """First field of a delimited line (the record id of a feed row)."""
    return F.substring_index(_col(line), sep, 1)
