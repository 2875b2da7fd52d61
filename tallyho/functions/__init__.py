"""Built-in Column expressions used by the operators (no Python UDFs)."""

from .keys import DEFAULT_LAST_KEY, first_field, parse_record_key, record_key
from .names import (
    NOISE_NAMES,
    drop_malformed,
    is_name,
    name_tokens,
    strip_offset,
)
from .render import counts_json, pair, ranked_list_text
from .times import (
    SLOT_MINUTES,
    as_instant,
    day_of_stamp,
    segment_name,
    slot_end,
    slot_start,
    stamp_instant,
    stamp_of,
)

__all__ = [
    "DEFAULT_LAST_KEY", "NOISE_NAMES", "SLOT_MINUTES", "as_instant",
    "counts_json", "day_of_stamp", "drop_malformed",
    "first_field", "is_name", "name_tokens", "pair", "parse_record_key",
    "ranked_list_text", "record_key", "segment_name",
    "slot_end", "slot_start", "stamp_instant", "stamp_of", "strip_offset",
]
