"""Small inputs with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Columns that operators might use themselves.
CLASHES = (
    "row", "host", "page", "line", "size", "quality", "kept", "n_words", "bands", "node", "cut", "key", "source_size",
    "lines", "level", "items", "marks", "spans", "measures", "id", "set_key", "n", "rate", "bad", "before", "t",
)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return (text or "").translate(LOWER)


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(f"w{r.randrange(400)}" for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls in every column, empty and
    very long texts, ties, repeated rows, odd white space and characters."""
    long_text = "\n".join(prose(k, 40) for k in range(3000))
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", None, "a", None),
        (4, "one", "en", None, 3),
        (5, "One two\x0bthree\nfour four", "en", "b", 1),
        (None, "no id here but some words in it", "en", "b", 1),
        (None, None, None, None, None),
        (6, "same text in two rows of one id", "en", "a", 1),
        (6, "same text in two rows of one id", "en", "a", 1),
        (7, "Ünïcode ÄÖ and é \U0001f600  wide space\x85next \x1c fs", "de", "b", 1),
        (8, long_text, "en", "a", len(long_text)),
        (9, "#*$%&|<> a#b " * 30, "en", "c", 1),
        (10, "\n\n\nline\nline\n\nline \n", "en", "c", 1),
        (11, "the same words the same words " * 40, "en", "c", 1),
    ]
    rows += [(20 + k, prose(k, 60) + "\nshared footer line\n" + prose(100 + k, 30), "en", "site", 1) for k in range(12)]
    rows += [(40 + k, prose(500, 80), "en", "copies", 1) for k in range(6)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def edge_documents(spark, extra: bool = False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit(f"x {c}") for c in CLASHES if c not in df.columns})
    return df


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def write_tables(spark, folder: str, docs, benchmark=None, pages=None) -> str:
    """The tables of a scale factor, with other contents."""
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    if benchmark is not None:
        benchmark.write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    if pages is not None:
        pages.write.mode("overwrite").parquet(f"{folder}/pages.parquet")
    return folder
