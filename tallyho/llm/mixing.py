"""Operator 1, mixing sources to target weights by Efraimidis-Spirakis keys.

Every source gets a budget of words. Whole passes over the source (epochs) come
first; what is left of the budget is filled by documents in the order of their
keys, -ln(u) / quality with u a uniform number from a hash of the id. The
documents with the smallest keys are a weighted sample without replacement.
Sizes are prefix-summed in that order, and a document is taken while that
brings the sum nearer to the budget.

The prefix sums go through ``operators.running``: rows are cut into pieces of
the whole order of key, id, size and a row number, so no source is sorted in one
task, and neither are rows of one id or without an id.

Defined results: null and empty texts have size 0; they add nothing and are taken
0 words, and they go with their source's whole passes. A null source is a source
of its own, ranked last. Rows with one id have equal keys and are ordered by size;
rows alike in that too are interchangeable. An empty table gives an empty mix. The
input's columns come back in one struct, ``row``. Texts don't pass through the
operator: the caller gives sizes, taken over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.running import running_sum
from .store import written
from .words import with_row

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def symbol_free(text: Column) -> Column:
    """Quality weight of a text, from 1 down to 0.1: a tenth of it symbols
    makes it the least."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - 9 * symbols / F.greatest(F.length(text), F.lit(1))), F.lit(0.1))


def uniform(key: Column) -> Column:
    """A number in (0, 1) from the key's hash: the same in every run."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / float(2**52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in the order of code points, null last, weigh as ``weights`` say,
    over and over. The sum of sizes is shared by weight; no source gets more
    than ``max_epochs`` times its size, and what is above goes to the others
    by weight. Those at their limit are the ones with the least limit for
    their weight, so with sources in that order the share of a unit of weight
    is found from prefix sums. One row per source goes to one task: a mix
    names its sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    per_unit = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    return (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", max_epochs * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("unit", per_unit)
        .withColumn(
            "share",
            F.first(F.when(F.col("unit") <= F.col("ratio"), F.col("unit")), ignorenulls=True).over(
                by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        )
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("share")).alias("target"))
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    size: str = "size",
    quality: str = "quality",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``docs`` as struct ``row`` with (size, source_size, target, epochs,
    repeats, taken): the mix takes each row ``repeats`` times.

    All columns of ``docs`` are stored and shuffled, so pass the columns
    named here and join texts to the result.
    """
    facts = with_row(docs).select(
        "row",
        F.col(f"row.{source}").alias("source"),
        F.col(f"row.{id_column}").alias("id"),
        F.col(f"row.{size}").alias("size"),
        (-F.log(uniform(F.col(f"row.{id_column}"))) / F.col(f"row.{quality}")).alias("key"),
    )
    # Written with the row number, which orders rows alike in all else.
    facts = written(facts.withColumn("place", F.monotonically_increasing_id()), "mix-facts")
    shares = targets(
        facts.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs
    ).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumnRenamed("source", "s")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    before = F.col("up_to") - F.col("size")
    # Nearer to the budget with the document than without it.
    more = (F.col("size") > 0) & (2 * before + F.col("size") < 2 * rest)
    return (
        running_sum(facts, ["source"], ["key", "id", "size", "place"], "size", "up_to")
        .join(shares, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("repeats", (F.col("epochs") + more.cast("long")).cast("long"))
        .select(
            "row", "size", "source_size", "target", "epochs", "repeats", (F.col("size") * F.col("repeats")).alias("taken")
        )
    )
