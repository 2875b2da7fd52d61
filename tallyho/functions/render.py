"""Pair, list and JSON rendering of name counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair(name: Column | str, n: Column | str) -> Column:
    """(name, count) pair as a struct (the original used a Scala tuple UDF)."""
    return F.struct(_col(name).alias("name"), _col(n).alias("n"))


def ranked_list_text(ranked: Column) -> Column:
    """``array<struct<rank, name, n>>`` -> ``name:n;name:n;...`` in rank order."""
    ordered = F.array_sort(ranked)
    return F.array_join(
        F.transform(ordered, lambda e: F.concat(e["name"], F.lit(":"), e["n"].cast("string"))),
        ";",
    )


def counts_json(entries: Column) -> Column:
    """``array<struct<name, count>>`` -> JSON array text, sorted by name.

    Same shape as the published delta message,
    ``[{"name":...,"count":...},...]``, but escaped by ``to_json``.
    """
    return F.to_json(F.array_sort(entries))
