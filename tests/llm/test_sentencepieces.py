"""Operator 13 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyho.llm import sentencepieces
from tests.conftest import SF_SMALL
from tests.llm.common import edge_documents, edge_rows, no_documents


@pytest.fixture(scope="module")
def model():
    with open(sentencepieces.public_model(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def encoder(model):
    return sentencepieces.Encoder(model, sentencepieces.load_pieces(model))


def same(encoder, library, text):
    ids = library.encode(text, add_eos=True)
    got = encoder.encode(text)
    assert got.tolist() == ids, repr(text[:80])
    assert encoder.decode(got) == library.decode(ids), repr(text[:80])


def test_awkward_texts(encoder, library):
    for text in (
        "", " ", "  ", "\n", "\x00", " a  b ", "a▁b", "▁", "x\r\ny\t", "<s> <0x0A> </s> <unk>", "中文①①", "\U0001f600" * 3,
        " " * 999 + "x" + " " * 40, "a" * 3000, "the" * 500, "=-" * 700, "0" * 99, "﻿a​", "éé",
    ):
        same(encoder, library, text)


def test_random_texts(encoder, library):
    r = random.Random(13)
    for alphabet in ("ab ", "aeinrst  .,\n", "▁ é中①x1.<>", "".join(map(chr, range(32, 1000)))):
        for _ in range(1500):
            same(encoder, library, "".join(r.choice(alphabet) for _ in range(r.randrange(60))))


def test_windows(encoder, library, monkeypatch):
    """A text in many windows, words longer than a window too."""
    monkeypatch.setattr(sentencepieces, "WINDOW", 7)
    for _, text, *_ in edge_rows():
        same(encoder, library, (text or "")[:5000])
    same(encoder, library, "extraordinarily " * 20 + "\U0001f600①" * 10)


def test_forgetting(model, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED_WORDS", 5)
    monkeypatch.setattr(sentencepieces, "REMEMBERED_PAIRS", 5)
    small = sentencepieces.Encoder(model, sentencepieces.load_pieces(model))
    for _, text, *_ in edge_rows():
        same(small, library, (text or "")[:3000])
    assert len(small.words) <= 5 and len(small.words.compatible) <= 5


def test_prefix_table_is_the_last_token(encoder, library):
    word = "▁internationalisation"
    table = encoder.words.prefix_table(word)
    for n in range(1, len(word) + 1):
        assert table[n - 1] == library.encode(word[1:n])[-1] if n > 1 else True


def test_without_byte_pieces(model):
    """A run of unknown characters is one unknown piece."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(model)
    spec.trainer_spec.byte_fallback = False
    for p in spec.pieces:
        if p.type == proto.ModelProto.SentencePiece.BYTE:
            p.type = proto.ModelProto.SentencePiece.CONTROL
    changed = spec.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=changed)
    ours = sentencepieces.Encoder(changed, sentencepieces.load_pieces(changed))
    for text in ("a①②b", "①", "x ① ①①\n\ny", "plain"):
        assert ours.encode(text).tolist() == library.encode(text, add_eos=True), text


def test_other_models_are_refused(model):
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(model)
    spec.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        sentencepieces.load_pieces(spec.SerializeToString())


def test_edge_rows(spark, library):
    docs = edge_documents(spark, extra=True)
    rows = sentencepieces.encode(docs).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        ids = library.encode(r["row"]["text"] or "", add_eos=True)
        assert list(r["ids"]) == ids
        assert r["decoded"] == library.decode(ids)
    assert sorted(rows[0]["row"].asDict()) == sorted(docs.columns)
    assert sentencepieces.encode(no_documents(spark)).count() == 0


def test_decode_of_ids(spark, library):
    lists = [[1, 28705, 264, 2], [], None, [3, 4, 259, 259], [28705, 30160, 229, 148, 163, 2]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "k int, ids array<int>")
    for r in sentencepieces.decode(df).collect():
        assert r["decoded"] == library.decode(lists[r["row"]["k"]] or [])


def test_query_equals_library(spark, library):
    got = {r["doc_id"]: r for r in entry.queries()["op13_sentencepiece"](spark, SF_SMALL).collect()}
    texts = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    rows = texts.collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = library.encode(text, add_eos=True)
        want = (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        )
        assert (got[doc_id]["n_tokens"], got[doc_id]["ids_sha256"], got[doc_id]["decoded_sha256"]) == want


def test_long_decode_in_windows(encoder, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "WINDOW", 3)
    ids = np.array(library.encode("  two  words ①② end", add_eos=True), np.int32)
    assert encoder.decode(ids) == library.decode(ids.tolist())
