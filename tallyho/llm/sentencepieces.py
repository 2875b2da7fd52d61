"""Operator 13, SentencePiece encoding with a prefix table, and decoding.

A merge-type (BPE) model joins the best pair of neighbours again and again. Its
result for a text fulfils, and alone fulfils, that every two neighbouring
tokens are compatible: encoding the two of them together gives those two. So
each prefix of a text has one last token, and it can be found from shorter
prefixes: of the pieces that end there (an Aho-Corasick automaton lists them),
it is the one that is compatible with the last token of the prefix before it. The
table holds this token for each prefix; the ids are recovered from its end
backwards. That is linear in the text, without the merges' priority queue. It
holds for any priorities, equal ones too (the leftmost pair is joined first).

Pieces that merges can't make are left out. Characters without a piece are
joined with nothing; they become their bytes' pieces, or the unknown piece (one
for a run of them) where the model has no bytes. Between two characters that stand
side by side in no piece a token ends, so texts are cut there into words, which
have a table each, and a worker remembers the ids of the words it has seen, as
far as ``REMEMBERED_WORDS`` allows.

Texts are normalised, and ids are decoded, by the sentencepiece library with the
same model. The model's bytes and its pieces are broadcast; their size is the
model's, whatever the data. The work is per text, without a shuffle.

Defined results: null and empty texts have the end id alone and decode to the
empty text. Texts of any length are encoded whole, in windows of about ``WINDOW``
characters cut between words; a word takes 4 bytes a character for its
table; the ids of a text must fit in one array. Equal rows give equal results. The
input's columns come back in one struct, ``row``.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyho.session import configure

from .words import with_row

#: Characters of a window of a text.
WINDOW = 1_000_000
#: Words and pairs of pieces that a worker remembers, and the longest such word.
REMEMBERED_WORDS = 500_000
REMEMBERED_PAIRS = 500_000
LONG_WORD = 64
_OUT_CHARS = 4_000_000
SPACE = "▁"


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- the model --------------------------------------------------------------


def joined(symbols: list[str], rank: dict[str, int], border: int | None = None) -> list[str] | None:
    """Plain merging: join the best pair of neighbours, the leftmost of equal ones,
    until none is a piece. None as soon as a pair across ``border`` (characters
    from the left) is joined."""
    symbols = list(symbols)
    worst = 1 << 60
    ranks = [rank.get(a + b, worst) for a, b in zip(symbols, symbols[1:], strict=False)]
    while ranks:
        best = min(ranks)
        if best == worst:
            break
        at = ranks.index(best)
        if border is not None and sum(map(len, symbols[: at + 1])) == border:
            return None
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = rank.get(symbols[at - 1] + symbols[at], worst)
        if at < len(ranks):
            ranks[at] = rank.get(symbols[at] + symbols[at + 1], worst)
    return symbols


@dataclass
class Pieces:
    """What encoding needs of a model."""

    ids: dict[str, int]  # pieces that merges make
    rank: dict[str, int]  # of every ordinary piece; equal scores, equal ranks
    bytes: list[int]  # the ids of the 256 byte pieces, or none
    unknown: int
    begin: int
    end: int


def load_pieces(model: bytes) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(model)
    kind = proto.ModelProto.SentencePiece
    if spec.trainer_spec.model_type != proto.TrainerSpec.BPE:
        raise ValueError("not a merge-type model")
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in spec.pieces):
        raise ValueError("models with pieces of a user's own or unused pieces are not supported")
    ordinary = {p.piece: (i, p.score) for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
    place = {score: k for k, score in enumerate(sorted({s for _, s in ordinary.values()}, reverse=True))}
    rank = {piece: place[score] for piece, (_, score) in ordinary.items()}
    special = {p.piece: i for i, p in enumerate(spec.pieces) if p.type != kind.NORMAL}
    return Pieces(
        ids={piece: i for piece, (i, _) in ordinary.items() if joined(list(piece), rank) == [piece]},
        rank=rank,
        bytes=[special[f"<0x{b:02X}>"] for b in range(256)] if spec.trainer_spec.byte_fallback else [],
        unknown=next(i for i, p in enumerate(spec.pieces) if p.type == kind.UNKNOWN),
        begin=special.get(spec.trainer_spec.bos_piece, -1),
        end=special.get(spec.trainer_spec.eos_piece, -1),
    )


# --- encoding ---------------------------------------------------------------


class Compatible(dict):
    """Whether a piece may follow a piece: the two, encoded together, stay those
    two. Keys are first id * ``FIRST`` + second id."""

    FIRST = 1 << 32

    def __init__(self, pieces: Pieces):
        self.text = {i: piece for piece, i in pieces.ids.items()}
        self.rank = pieces.rank

    def __missing__(self, pair: int) -> bool:
        if len(self) >= REMEMBERED_PAIRS:
            self.clear()
        a, b = self.text[pair // self.FIRST], self.text[pair % self.FIRST]
        self[pair] = out = joined([*a, *b], self.rank, len(a)) is not None
        return out


class Words(dict):
    """The ids of words, four bytes each, made when first asked for."""

    def __init__(self, pieces: Pieces):
        import ahocorasick

        self.pieces = pieces
        self.compatible = Compatible(pieces)
        self.length = {i: len(piece) for piece, i in pieces.ids.items()}
        self.known = {c for piece in pieces.ids for c in piece}
        self.automaton = ahocorasick.Automaton()
        for piece, i in pieces.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def __missing__(self, word: str) -> bytes:
        out = (self.encode(word) if word[0] in self.known else self.unknown(word)).tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = out
        return out

    def unknown(self, word: str) -> array:
        if self.pieces.bytes:
            return array("i", [self.pieces.bytes[b] for b in word.encode()])
        return array("i", [self.pieces.unknown])

    def prefix_table(self, word: str) -> list[int] | array:
        """The last token of each prefix (all characters have pieces)."""
        last = [-1] * len(word) if len(word) <= LONG_WORD else array("i", [-1]) * len(word)
        compatible, first = self.compatible, Compatible.FIRST
        for end, (piece, length) in self.automaton.iter(word):
            if last[end] < 0:
                before = end - length
                if before < 0 or compatible[last[before] * first + piece]:
                    last[end] = piece
        return last

    def encode(self, word: str) -> array:
        last, length = self.prefix_table(word), self.length
        out, at = array("i"), len(word) - 1
        while at >= 0:
            piece = last[at]
            out.append(piece)
            at -= length[piece]
        out.reverse()
        return out


class Encoder:
    """Encoding and decoding as the library does, for one model."""

    def __init__(self, model: bytes, pieces: Pieces):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = pieces
        self.words = Words(pieces)
        #: Numbers of the characters that have pieces (others: 0), and which two
        #: of them stand side by side in some piece.
        self.number = np.zeros(0x110000, np.uint16 if len(self.words.known) < 2**16 else np.uint32)
        for k, c in enumerate(sorted(self.words.known), 1):
            self.number[ord(c)] = k
        n = len(self.words.known) + 1
        pairs = {a + b for piece in pieces.ids for a, b in zip(piece, piece[1:], strict=False)}
        self.tied = np.zeros(n * n, bool)
        self.tied[[int(self.number[ord(a)]) * n + int(self.number[ord(b)]) for a, b in pairs]] = True
        self.tied[0] = not pieces.bytes  # a run of characters without a piece is one unknown
        self.n = n
        #: A piece that decoding puts in front of a later window, so that its
        #: first space isn't taken for the one that normalising added.
        self.front = next(i for piece, i in pieces.ids.items() if len(piece) == 1 and piece != SPACE)
        self._bytes = set(pieces.bytes)

    def borders(self, text: str) -> list[int]:
        """The places between characters that no piece holds side by side."""
        numbers = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
        return (np.flatnonzero(~self.tied[numbers[:-1] * self.n + numbers[1:]]) + 1).tolist()

    def windows(self, text: str) -> Iterator[list[str]]:
        """The words of a text, some at a time."""
        at, size = 0, WINDOW
        while at < len(text):
            window = text[at : at + size]
            cuts = self.borders(window)
            if at + size >= len(text):
                cuts.append(len(window))
            if not cuts:  # a word longer than the window
                size *= 2
                continue
            yield [window[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
            at, size = at + cuts[-1], WINDOW

    def encode(self, text: str, add_begin: bool = False, add_end: bool = True) -> np.ndarray:
        parts = [np.array([self.pieces.begin] * add_begin, np.int32)]
        for words in self.windows(self.library.normalize(text) if text else ""):
            parts.append(np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32))
        parts.append(np.array([self.pieces.end] * add_end, np.int32))
        return np.concatenate(parts)

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode, a window at a time; bytes of a character stay
        together."""
        out, at = [], 0
        while at < len(ids) or not at:
            end = min(at + WINDOW, len(ids))
            while end < len(ids) and int(ids[end]) in self._bytes:
                end += 1
            part = ids[at:end].tolist()
            out.append(self.library.decode([self.front, *part])[1:] if at else self.library.decode(part))
            at = max(end, 1)
        return "".join(out)


# --- on DataFrames ----------------------------------------------------------


def _shared(spark: SparkSession, model_path: str) -> Callable[[], Encoder]:
    configure(spark)
    with open(model_path, "rb") as f:
        model = f.read()
    # Plain values: what is broadcast is pickled with its classes' names.
    shared = spark.sparkContext.broadcast({"model": model, "pieces": vars(load_pieces(model))})

    def get() -> Encoder:
        held = shared.value
        if "encoder" not in held:
            held["encoder"] = Encoder(held["model"], Pieces(**held["pieces"]))
        return held["encoder"]

    return get


def _mapped(df: DataFrame, column: str, added: list[tuple[str, T.DataType]], one: Callable) -> DataFrame:
    """``df`` with what ``one()`` makes of each value of a field of ``row``."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, k) for n, k in added)])

    def arrow(values: list) -> pa.Array:
        if isinstance(values[0], str):
            return pa.array(values, pa.string())
        offsets = np.cumsum([0, *map(len, values)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = one()
        for rows in batches:
            values = pc.struct_field(rows.column(0), column)
            made, begin, size = [], 0, 0
            for at in range(rows.num_rows):
                made.append(make(values[at]))
                size += 1 + max(map(len, made[-1]))
                if size >= _OUT_CHARS or at + 1 == rows.num_rows:
                    columns = [arrow(list(c)) for c in zip(*made, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(begin, at + 1 - begin) for c in rows.columns), *columns], names=schema.names
                    )
                    made, begin, size = [], at + 1, 0

    return df.mapInArrow(run, schema)


def encode(
    docs: DataFrame, text: str = "text", model_path: str | None = None, add_begin: bool = False, add_end: bool = True
) -> DataFrame:
    """``docs`` as struct ``row`` with ``ids`` (array<int>), the tokens of each text, and
    ``decoded``, the text that they stand for."""
    get = _shared(docs.sparkSession, model_path or public_model())

    def one() -> Callable:
        encoder = get()

        def make(value: pa.Scalar) -> tuple[np.ndarray, str]:
            ids = encoder.encode(value.as_py() or "", add_begin, add_end)
            return ids, encoder.decode(ids)

        return make

    return _mapped(with_row(docs), text, [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())], one)


def decode(rows: DataFrame, ids: str = "ids", model_path: str | None = None) -> DataFrame:
    """``rows`` as struct ``row`` with ``decoded``, the text of an array of ids (null: empty)."""
    get = _shared(rows.sparkSession, model_path or public_model())

    def one() -> Callable:
        encoder = get()
        return lambda value: (encoder.decode(np.array(value.as_py() or [], np.int32)),)

    return _mapped(with_row(rows), ids, [("decoded", T.StringType())], one)
