"""Operator 5, edit-aware token counts with a segment tree for each document.

A text is cut into leaves of about ``LEAF`` characters, always between a character
that isn't white space and a space or newline. The tokenizer's pattern never
joins across such a place and never looks behind it, so the leaves' counts add
up exactly to the text's. The counts are the leaves of a binary tree of sums.

An edit replaces a range of characters. The boundaries that it leaves alone on
both sides stay valid, so only the leaves in between are cut and encoded anew,
and only the sums above them are updated. A region that has grown beyond two leaves'
size is cut into more, one that has become small is joined with the leaf behind it,
and an empty one leaves; then the sums are made anew from the counts, without
encoding. So leaves stay below twice ``LEAF`` (and the rest of a word), and an edit
encodes the leaves that it touches and one more at most.

Trees are columns (leaf lengths, tree), so they can be stored beside the text
and edited later. Everything is per-document work without a shuffle. The
vocabulary file's bytes are broadcast; their size is the vocabulary's, whatever
the data. A Python worker builds the encoder once.

Defined results: null and empty texts have one leaf of 0 tokens; a null text stays
null and its edits are ignored. A text without a place to cut is one leaf. Edits
must be in order and not overlap; they are clipped to the text. Equal rows give
equal results. The input's columns come back in one struct, ``row``. Texts of any
length are cut into leaves as a whole; one text and its tree must fit in a worker.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyho.session import configure

from .words import with_row

LEAF = 1000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the vocabulary's merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=\S)[ \n]")
_OUT_BYTES = 8_000_000

Count = Callable[[str], int]
Edit = tuple[int, int, str]


def load_counter(data: bytes, pattern: str = PATTERN) -> Count:
    """Token counter of a rank file's bytes; special tokens are plain text."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def cut(text: str, leaf: int = LEAF) -> list[str]:
    """The leaves of a text; at least one."""
    out, at = [], 0
    while len(text) - at > leaf:
        found = _CUT.search(text, at + leaf)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


def tree_of(counts: list[int]) -> list[int]:
    """Sums in heap order: the root at 1, the children of i at 2i and 2i + 1,
    the leaves in the last half."""
    half = 1 << max(0, len(counts) - 1).bit_length()
    tree = [0] * half + counts + [0] * (half - len(counts))
    for i in range(half - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def set_leaf(tree: list[int], leaf: int, count: int) -> None:
    """Change a leaf's count and the sums above it."""
    at = len(tree) // 2 + leaf
    change = count - tree[at]
    while at and change:
        tree[at] += change
        at //= 2


def build(text: str, count: Count, leaf: int = LEAF) -> tuple[list[int], list[int]]:
    """(leaf lengths, tree) of a text."""
    leaves = cut(text, leaf)
    return [len(x) for x in leaves], tree_of([count(x) for x in leaves])


def edit(
    text: str, lengths: list[int], tree: list[int], edits: list[Edit], count: Count, leaf: int = LEAF
) -> tuple[str, list[int], list[int], int]:
    """(new text, new lengths, new tree, characters encoded) after ``edits``,
    given by places in the old text."""
    lengths, tree = list(lengths), list(tree)
    counts = tree[len(tree) // 2 :][: len(lengths)]
    edits = [(max(0, s), min(len(text), max(s, e)), r) for s, e, r in edits]
    starts, at = [], 0
    for n in lengths:
        starts.append(at)
        at += n
    # Leaves that are no longer bounded as before, in groups of neighbours.
    groups: list[tuple[int, int, list[Edit]]] = []  # first leaf, last leaf, edits
    leaf_at = 0
    for e in edits:
        # The last boundary before the edit, the first behind it.
        while leaf_at + 1 < len(starts) and starts[leaf_at + 1] < e[0]:
            leaf_at += 1
        last = leaf_at
        while last + 1 < len(starts) and starts[last + 1] <= e[1]:
            last += 1
        if groups and leaf_at <= groups[-1][1]:
            groups[-1] = (groups[-1][0], max(groups[-1][1], last), [*groups[-1][2], e])
        else:
            groups.append((leaf_at, last, [e]))
    parts, done, encoded = [], 0, 0
    new_lengths, new_counts, kept = [], [], 0  # leaves up to kept are done
    changed, as_many = [], True  # (leaf, count); whether each region has as many leaves as before
    for g, (first, last, own) in enumerate(groups):
        begin, end = starts[first], starts[last] + lengths[last]
        region, at = [], begin
        for s, e, r in own:
            region += [text[at:s], r]
            at = e
        new = "".join([*region, text[at:end]])
        behind = groups[g + 1][0] if g + 1 < len(groups) else len(lengths)
        if len(new) < leaf // 4 and last + 1 < behind:
            last += 1
            new, end = new + text[end : end + lengths[last]], end + lengths[last]
        leaves = cut(new, leaf) if len(new) > 2 * leaf else [new] if new else []
        made = [count(x) for x in leaves]
        as_many = as_many and len(leaves) == last - first + 1
        changed += zip(range(first, last + 1), made, strict=False)
        new_lengths += [*lengths[kept:first], *map(len, leaves)]
        new_counts += [*counts[kept:first], *made]
        kept = last + 1
        encoded += len(new)
        parts += [text[done:begin], new]
        done = end
    new_lengths, new_counts = new_lengths + lengths[kept:] or [0], new_counts + counts[kept:] or [0]
    if as_many:
        for k, c in changed:
            set_leaf(tree, k, c)
    else:
        tree = tree_of(new_counts)
    return "".join([*parts, text[done:]]), new_lengths, tree, encoded


# --- on DataFrames ----------------------------------------------------------

_TREE = "leaf_lengths array<int>, tree array<int>"


def _counter(spark: SparkSession, vocabulary: str, pattern: str) -> Callable[[], Count]:
    configure(spark)
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast({"data": f.read()})

    def get() -> Count:
        held = shared.value
        if "count" not in held:
            held["count"] = load_counter(held["data"], pattern)
        return held["count"]

    return get


def _mapped(df: DataFrame, added: str, run_row: Callable[[], Callable]) -> DataFrame:
    """``df`` with columns ``added``, made by Python from the values of each
    row."""
    fields = T._parse_datatype_string(added).fields
    own = list(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        one = run_row()
        kinds = [to_arrow_type(f.dataType) for f in fields]

        def batch(rows: pa.RecordBatch, made: list[tuple]) -> pa.RecordBatch:
            columns = zip(*made, strict=True)
            return pa.RecordBatch.from_arrays(
                [*rows.columns, *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                names=[*own, *(f.name for f in fields)],
            )

        for rows in batches:
            made, begin, size = [], 0, 0
            for at in range(rows.num_rows):
                made.append(one(rows, at))
                size += sum(len(x) for x in made[-1] if isinstance(x, str))
                if size >= _OUT_BYTES:
                    yield batch(rows.slice(begin, at + 1 - begin), made)
                    made, begin, size = [], at + 1, 0
            if made:
                yield batch(rows.slice(begin), made)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def build_trees(
    docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN, leaf: int = LEAF
) -> DataFrame:
    """``docs`` as struct ``row`` with (leaf_lengths, tree); the root ``tree[1]`` is
    the text's number of tokens."""
    get = _counter(docs.sparkSession, vocabulary, pattern)

    def start() -> Callable:
        count = get()
        return lambda rows, at: build(pc.struct_field(rows.column(0), text)[at].as_py() or "", count, leaf)

    return _mapped(with_row(docs), _TREE, start)


def masking_edits(value: str, pattern: re.Pattern, mask: str) -> list[Edit]:
    return [(m.start(), m.end(), mask) for m in pattern.finditer(value)]


def edit_trees(
    trees: DataFrame,
    edits_of: Callable[[str], list[Edit]],
    text: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    leaf: int = LEAF,
) -> DataFrame:
    """The rows of ``build_trees`` after the edits that ``edits_of`` makes of each
    text: (row, leaf_lengths, tree) with (n_edits, n_encoded_chars, new_text,
    new_leaf_lengths, new_tree)."""
    get = _counter(trees.sparkSession, vocabulary, pattern)

    def start() -> Callable:
        count = get()

        def one(rows: pa.RecordBatch, at: int) -> tuple:
            old = pc.struct_field(rows.column(0), text)[at].as_py()
            lengths, tree = rows.column(1)[at].as_py(), rows.column(2)[at].as_py()
            edits = edits_of(old) if old else []
            if not edits:
                return 0, 0, old, lengths, tree
            new, new_lengths, new_tree, encoded = edit(old, lengths, tree, edits, count, leaf)
            return len(edits), encoded, new, new_lengths, new_tree

        return one

    return _mapped(
        trees,
        "n_edits bigint, n_encoded_chars bigint, new_text string, new_leaf_lengths array<int>, new_tree array<int>",
        start,
    )
