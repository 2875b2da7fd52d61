"""Top names per day (batch): explode -> cut offset -> count -> rank.

Plan shape: scan -> Generate(explode) -> partial HashAggregate ->
Exchange(day, name) -> final HashAggregate -> WindowGroupLimit (partial top-k
per task) -> Exchange(day) -> WindowGroupLimit -> Window. Two shuffles; the
second one moves at most k rows per day per task, so a day holding a third
of all mentions costs nothing extra, and a name holding a third of all
mentions is combined map-side before the first shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import NOISE_NAMES, is_name, name_tokens, strip_offset
from ..functions.render import pair, ranked_list_text

DEFAULT_K = 10
# days shown by the raw-line job (its take(10) over per-day rows)
FIRST_DAYS = 10


def explode_names(
    articles: DataFrame,
    strip: str = "last",
    noise: Iterable[str] = NOISE_NAMES,
    keep: Sequence[str] = ("day",),
    names_col: str = "AllNames",
) -> DataFrame:
    """One row per mentioned name: (*keep, name). Empty, null and noise
    names are dropped after the offset is cut, and articles without a key (a
    date that doesn't parse) are dropped."""
    # Cut and filtered inside the list: each token is cut once. A filter on
    # the exploded names would cut them again for the filter.
    names = F.filter(
        F.transform(name_tokens(names_col), lambda t: strip_offset(t, strip)), lambda n: is_name(n, noise)
    )
    keyed = articles.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keep]))
    return keyed.select(*keep, F.explode(names).alias("name"))


def count_names(mentions: DataFrame, by: Sequence[str] = ("day",)) -> DataFrame:
    """(*by, name, n): mentions per key and name."""
    return mentions.groupBy(*by, "name").agg(F.count(F.lit(1)).alias("n"))


def rank_top(counts: DataFrame, k: int = DEFAULT_K, by: Sequence[str] = ("day",)) -> DataFrame:
    """Top k per key by count desc, ties by name asc; adds ``rank`` 1..k."""
    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("name"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_names_per_day(
    articles: DataFrame,
    k: int = DEFAULT_K,
    strip: str = "last",
    noise: Iterable[str] = NOISE_NAMES,
) -> DataFrame:
    """(day, rank, name, n) for the k most mentioned names of every day."""
    top = rank_top(count_names(explode_names(articles, strip, noise)), k)
    return top.select("day", "rank", "name", "n")


def top_lists(top: DataFrame, by: Sequence[str] = ("day",), k: int = DEFAULT_K) -> DataFrame:
    """(*by, top_names): each key's ranked list as one ``name:n;...`` text.

    Runs after the rank filter, so each group holds at most k rows.
    """
    grouped = top.groupBy(*by).agg(
        F.collect_list(F.struct("rank", "name", "n")).alias("_top")
    )
    return grouped.select(*by, ranked_list_text(F.slice(F.array_sort("_top"), 1, k)).alias("top_names"))


def top_pairs(top: DataFrame, by: Sequence[str] = ("day",)) -> DataFrame:
    """(*by, top): each key's ranked list as ``array<struct<name, n>>`` in
    rank order - the nested form of the original job's per-day result.
    Runs after the rank filter, so each group holds at most k rows."""
    grouped = top.groupBy(*by).agg(F.collect_list(F.struct("rank", pair("name", "n").alias("p"))).alias("_top"))
    return grouped.select(*by, F.transform(F.array_sort("_top"), lambda e: e["p"]).alias("top"))


def first_days(per_day: DataFrame, days: int = FIRST_DAYS) -> DataFrame:
    """Rows of the earliest ``days`` days only (the RDD job's take(10)).

    ``per_day`` is a ranked result (at most k rows per day, so its size is
    set by the calendar, not the data); the days are numbered on it with
    ``dense_rank``, which reads it once. Joining a day list back would
    compute the whole top-k plan a second time.
    """
    order = Window.orderBy("day")
    numbered = per_day.withColumn("_day_no", F.dense_rank().over(order))
    return numbered.where(F.col("_day_no") <= days).drop("_day_no")
