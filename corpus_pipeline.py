"""The corpus pipeline: raw documents to a weighted mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and is the next stage's docs. All stages but the last return
the columns of documents; the last adds how often each document is taken.

``doc_id`` names a document: rows with one id are copies of one document, of
which the near-duplicate stage keeps one. Rows without an id are kept by every
stage that their text passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm import decontam, linededup, mixing, neardup, quality
from tallyho.llm.oracle import PIPELINE
from tallyho.llm.store import written
from tallyho.llm.words import with_row
from tallyho.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the document rules, on hosts that pass theirs."""
    return quality.judge(docs).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their host's boilerplate lines; ``n_chars`` follows
    the text."""
    cleaned = linededup.drop_boilerplate(docs)
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return cleaned.select(
        *(
            F.when(F.col("n_dropped") > 0, new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`")
            for c in docs.columns
        )
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest
    id, and of repeated rows of that id the one with the least text.

    Only the ids of what goes are joined, so texts aren't shuffled while those
    are few enough to broadcast. Of rows with a repeated id each task hands on one.
    """
    groups = written(neardup.near_duplicates(docs.select("doc_id", "text")), "near-duplicates")
    gone = written(groups.where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "near-gone")
    twice = written(
        groups.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("twice")).count().where("count > 1").select("twice"),
        "near-repeated",
    )
    kept = with_row(docs).join(gone, F.col("row.doc_id") == F.col("gone"), "left_anti")
    single = kept.join(twice, F.col("row.doc_id") == F.col("twice"), "left_anti")
    repeated = kept.join(twice, F.col("row.doc_id") == F.col("twice"), "left_semi")
    order = F.struct(F.col("row.text").isNull(), F.col("row.text"), F.to_json("row"))
    one = repeated.groupBy("row.doc_id").agg(F.min_by("row", order).alias("row"))
    return single.select("row.*").union(one.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.scan_documents(docs, benchmark).where("not contaminated").select("row.*")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their size, their source's size
    and target, and how often they are taken: ``mix_size``, ``mix_source_size``,
    ``mix_target``, ``mix_repeats`` (with ``_`` added where documents have such a
    column)."""

    def free(name: str) -> str:
        return free(name + "_") if name in docs.columns else name

    facts = docs.select(
        "doc_id",
        "source",
        mixing.n_words(F.col("text")).alias("size"),
        mixing.symbol_free(F.col("text")).alias("quality"),
        F.xxhash64("text").alias("text_hash"),
    )
    mix = mixing.mix(facts).where("repeats > 0")
    # A document is told by its id, and without one by its text.
    taken = mix.groupBy(
        F.col("row.doc_id").alias("id"), F.col("row.source").alias("of"), F.col("row.text_hash").alias("hash")
    ).agg(*(F.max(c).alias(f"mix_{c}") for c in ("size", "source_size", "target", "repeats")))
    joined = with_row(docs).join(
        taken,
        F.col("row.doc_id").eqNullSafe(F.col("id"))
        & F.col("row.source").eqNullSafe(F.col("of"))
        & (F.xxhash64("row.text") == F.col("hash")),
    )
    added = ("mix_size", "mix_source_size", "mix_target", "mix_repeats")
    return joined.select("row.*", *(F.col(c).alias(free(c)) for c in added))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
]

ORACLE_SQL = PIPELINE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
