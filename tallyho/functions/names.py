"""Name-list parsing: ``name,offset;name,offset;...`` -> one name per row.

Everything here is a built-in Column expression, so it stays inside
whole-stage code generation; there is no Python UDF on this path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that are not names and are dropped after the offset
# is cut, as in the original batch job's two filters.
NOISE_NAMES = ("null", "Type ParentCategory")

# Separators of the nested name list.
TOKEN_SEP = ";"
OFFSET_SEP = ","

# Replacement character the UTF-8 decoder puts where bytes were malformed.
REPLACEMENT_CHAR = "�"

STRIP_MODES = ("last", "first")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_malformed(text: Column | str) -> Column:
    """Drop malformed UTF-8: text readers keep invalid bytes as they are,
    ``make_valid_utf8`` turns each into U+FFFD, and those are removed (a
    genuine U+FFFD in the data goes too)."""
    return F.replace(F.make_valid_utf8(_col(text)), F.lit(REPLACEMENT_CHAR), F.lit(""))


def name_tokens(all_names: Column | str) -> Column:
    """Split the list column into its ``name,offset`` tokens (array)."""
    return F.split(_col(all_names), TOKEN_SEP, -1)


def strip_offset(token: Column | str, strip: str = "last") -> Column:
    """Cut the offset from one token.

    ``last``: keep everything before the last comma (``Smith, John,12`` ->
    ``Smith, John``). ``first``: keep everything before the first comma
    (-> ``Smith``). A token without a comma is kept whole in both modes.
    """
    tok = _col(token)
    if strip == "first":
        return F.substring_index(tok, OFFSET_SEP, 1)
    if strip != "last":
        raise ValueError(f"strip must be one of {STRIP_MODES}, got {strip!r}")
    tail = F.substring_index(tok, OFFSET_SEP, -1)  # text after the last comma
    return F.when(
        F.instr(tok, OFFSET_SEP) > 0,
        tok.substr(F.lit(1), F.length(tok) - F.length(tail) - F.lit(1)),
    ).otherwise(tok)


def is_name(name: Column | str, noise: Iterable[str] = NOISE_NAMES) -> Column:
    """True for a real name: not null, not empty, not a noise token."""
    n = _col(name)
    noise = list(noise)
    cond = n.isNotNull() & (n != F.lit(""))
    if noise:
        cond = cond & ~n.isin(noise)
    return cond
