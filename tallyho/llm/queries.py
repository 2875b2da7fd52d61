"""One query per operator, each over its whole table.

A query projects the columns its operator reads, runs it with production
parameters, and derives the digest columns its contract names.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.session import configure

from . import decontam, linededup, lm, manifest, mixing, neardup, pii, prefixtrie, quality, sentencepieces, tokencounts, urlfilter, warc
from .store import fresh_path
from .oracle import SQL

__all__ = ["QUERIES", "SQL"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        mixing.n_words(F.col("text")).alias("size"),
        mixing.symbol_free(F.col("text")).alias("quality"),
    )
    return mixing.mix(docs).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "epochs", "repeats", "taken"
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", lm.held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    model = lm.train(docs.where(~F.col("held_out")).select("text"))
    return lm.score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.held_out").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        lm.perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_boilerplate(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "clean_text"
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all texts, before and after e-mail addresses and long
    numbers are masked."""
    trees = tokencounts.build_trees(table(spark, sf_dir, "documents").select("doc_id", "text"))
    masked = re.compile(r"[0-9]{7,}|[\w.+-]+@[\w-]+\.[\w.-]+")
    edited = tokencounts.edit_trees(trees, lambda text: tokencounts.masking_edits(text, masked, "<masked>"))
    return edited.select(
        F.col("row.doc_id").alias("doc_id"),
        F.element_at("tree", 2).cast("long").alias("n_tokens"),
        F.size("leaf_lengths").cast("long").alias("n_leaves"),
        "n_edits",
        "n_encoded_chars",
        F.element_at("new_tree", 2).cast("long").alias("n_tokens_after"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    warc.write_archive(warc.archive_records(table(spark, sf_dir, "pages")), folder)
    return warc.page_records(spark, folder)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontam.scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = quality.judge(docs)
    return judged.select(F.col("row.doc_id").alias("doc_id"), *quality.MEASURES, "base_failed", "kept")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urlfilter.judge(pages, urlfilter.rules_table(spark))


#: For the registered query only; a real key is given by the caller.
DEMO_KEY = "tallyho"


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, DEMO_KEY).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("found").cast("long").alias("n_found"),
        F.size(F.filter(F.zip_with("found", "replaced", lambda a, b: a != b), lambda x: x))
        .cast("long")
        .alias("n_replaced"),
        "clean_text",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with turns of the first of their hundred."""
    own = prefixtrie.turns(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv").cast("string")) % 6
    rebuilt = prefixtrie.with_heads(own, head, F.col("conv") - F.col("conv") % 100)
    return prefixtrie.prefix_trie(rebuilt, own.where("pos = 1"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is tampered with: their text is lower-cased."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    made = manifest.manifest(
        table(spark, sf_dir, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        "doc_id",
        "lang",
        tampered,
        {"text": F.translate("text", urlfilter.UPPER, urlfilter.LOWER)},
    )
    return manifest.verified(made).select(
        F.col("row.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_line_dedup": op3_line_dedup,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filters": op9_url_filters,
    "op10_pii_pseudonyms": op10_pii_pseudonyms,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_sentencepiece": op13_sentencepiece,
}
