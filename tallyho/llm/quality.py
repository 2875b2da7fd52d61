"""Operator 8, quality rules: document rules, then a verdict on each host.

Documents are measured and judged by fixed rules. Failures are summed by host,
each host's failure rate is shrunk towards the corpus by a beta prior fitted to
the hosts (empirical Bayes, by moments), and hosts whose shrunk rate exceeds a
limit are rejected with all their documents.

Defined results: a null or empty text has no words, so it fails. A null host is a
host of its own. Repeated rows are judged each. An empty table gives an empty
result. The input's columns come back in one struct, ``row``, so they may have any
name. Texts are read whole, and one text takes about 60 bytes of a worker for each
of its bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import written

MIN_WORDS = 50
MAX_REPEATED_PCT = 50
#: A host is rejected when its shrunk rate of failed documents exceeds this.
MAX_HOST_RATE = 0.6
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _distinct_per_text(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each text has."""
    keyed = W.mix(hashes + owner.astype(np.uint64) * W.STEP)
    _, at = np.unique(keyed, return_index=True)
    return np.bincount(owner[at], minlength=n)


def measure_texts(t: W.Texts) -> dict[str, np.ndarray]:
    """The five measures of each text of a slice."""
    n_words = np.diff(t.first)
    # Lines: cut at newlines and text ends; only lines with a word count.
    newline = np.flatnonzero(t.data == 0x0A)
    begins = np.sort(np.concatenate([t.at[:-1], newline + 1]))
    ends = np.sort(np.concatenate([t.at[1:], newline]))
    worded = np.searchsorted(t.starts, ends) > np.searchsorted(t.starts, begins)
    begins, ends = begins[worded], ends[worded]
    owner = t.owner(begins)
    n_lines = np.bincount(owner, minlength=t.n)
    n_dup = n_lines - _distinct_per_text(owner, t.hashes(begins, ends), t.n)
    # Words in windows that occur twice or more in their text.
    word_owner = np.repeat(np.arange(t.n), n_words)
    grams = W.windows(t.words(), WINDOW)
    repeated = np.zeros(len(word_owner), bool)
    if len(grams):
        own = word_owner[: len(grams)]
        whole = np.flatnonzero(own == word_owner[WINDOW - 1 :])
        keyed = W.mix(grams[whole] + own[whole].astype(np.uint64) * W.STEP)
        order = np.argsort(keyed)
        same = keyed[order][1:] == keyed[order][:-1]
        twice = np.zeros(len(whole), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = whole[twice]
        for k in range(WINDOW):
            repeated[at + k] = True
    return {
        "n_words": n_words,
        "word_chars": t.count(t.solid & ((t.data & 0xC0) != 0x80)),
        "n_symbols": t.count(_SYMBOL[t.data]),
        "n_dup_lines": n_dup,
        "n_repeat_words": np.bincount(word_owner[repeated], minlength=t.n),
    }


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as struct ``row`` beside the five measures."""
    return W.map_texts(docs, text, measure_texts, {m: "bigint" for m in MEASURES}, lower=False)


def document_fails() -> Column:
    """The rules on a document alone."""
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * n)


def host_rates(failures: DataFrame) -> DataFrame:
    """(host, n, fails, rate) for each host of (host, failed) rows; the rate is
    shrunk by the prior.

    The beta prior has the mean m of the hosts' own rates, and their variance v
    less what drawing n documents of a host adds to it, (m(1 - m) - s) / n
    for a prior of variance s (beta-binomial moments): s is
    (v - m(1 - m)a) / (1 - a), with a the mean of 1 / n. The prior weighs
    m(1 - m)/s - 1 documents, at least none and at most as many as all hosts
    have. That many also where s isn't above 0, so where hosts differ no more
    than by chance, or all have one document.
    """
    # Summed before the shuffle: a hot host sends one row per task.
    hosts = written(
        failures.groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("fails")
        ),
        "host-failures",
    )
    own = F.col("fails") / F.col("n")
    m, v, a, total = hosts.agg(
        *(F.coalesce(x, F.lit(0.0)) for x in (F.avg(own), F.var_pop(own), F.avg(1 / F.col("n")))),
        F.coalesce(F.sum("n"), F.lit(0)),
    ).first()  # four numbers
    spread = (v - m * (1 - m) * a) / (1 - a) if a < 1 else 0.0
    weight = min(max(0.0, m * (1 - m) / spread - 1), float(total)) if spread > 0 else float(total)
    return hosts.withColumn("rate", (F.col("fails") + m * weight) / (F.col("n") + weight))


def judge(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` as struct ``row`` beside the measures, ``base_failed`` and
    ``kept``.

    The measures are taken twice, for the hosts and for the documents, so that
    no text is shuffled or stored. Only rejected hosts are joined back; Spark
    broadcasts them while they are few and else splits hot hosts.
    """
    failures = measure(docs.select(F.col(host).alias("host"), F.col(text).alias("text"))).select(
        F.col("row.host").alias("host"), document_fails().alias("failed")
    )
    rejected = host_rates(failures).where(F.col("rate") > MAX_HOST_RATE).select("host", F.lit(True).alias("bad"))
    return (
        measure(docs, text)
        .join(rejected, F.col(f"row.{host}").eqNullSafe(F.col("host")), "left")
        .select(
            "row",
            *MEASURES,
            document_fails().alias("base_failed"),
            (~document_fails() & F.col("bad").isNull()).alias("kept"),
        )
    )
