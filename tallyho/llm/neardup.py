"""Operator 4, MinHash near-dedup with odd sketches.

1. Each text becomes the set of its word shingles, and from the set a MinHash
   signature, cut into bands, and an odd sketch: the smallest hash of each of
   ``BINS`` bins (one-permutation MinHash) flips one bit of a bitmap, so the bits in
   which two bitmaps differ tell how many samples differ. Sets smaller than
   the bins are nearly sampled whole, which makes the estimate of their
   difference almost exact.
2. Texts with equal sets are one class; only classes go on.
3. Classes that share a band are candidates. In each bucket all members are
   first paired with one class (a star, not all pairs). Pairs whose sizes or
   odd sketches rule out the threshold are dropped, the others are confirmed
   on the full sets, and the components of these links are taken.
4. Buckets that still hold several components go on. Shingles that only one of
   their classes has can't be common to any pair, which gives an exact upper
   bound of what a class can share. Of what that bound leaves, each bucket's
   class with the fewest such shingles, the middle of a group of copies, is
   paired with the members of other components, and components are taken again.
5. In buckets that still hold several components, the pairs across components
   that bound, sizes and sketches leave are confirmed. So every pair that
   shares a bucket is tested, ruled out, or already in one component, and a
   bucket of thousands of mutual copies costs thousands of tests, not their
   square.
6. The components of all links are the result.

Two sets of the threshold's similarity share no band with a chance of
(1 - 0.75**4)**32 = 5e-6; the sketch drops such a pair with about 1e-6.

Defined results: a text without words (null, empty) has no shingles, is linked
with nothing and is its own component. A null id is never linked; its component is
null and it is kept. Rows with one id are one document. Ties can't arise: the
smallest id wins. Input columns other than id and text are not read. Texts are
read whole, and one text takes about 60 bytes of a worker for each of its bytes.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .store import written

SHINGLE = 5
THRESHOLD_PCT = 75
BANDS, BAND_ROWS = 32, 4
SAMPLES = BANDS * BAND_ROWS
#: Bins of the samples behind the odd sketch, and bits of the sketch.
BINS = 2048
SKETCH_BITS = 2048
#: Standard deviations that the sketch of a pair at the threshold may be off.
SIGMAS = 5
_BLOCK = 4096  # shingles hashed at a time, so long texts need no more memory

_rng = np.random.default_rng(7041776)
_FACTORS = _rng.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 2**64, SAMPLES, dtype=np.uint64)
_SALTS = _rng.integers(1, 2**64, (2, max(BANDS, SHINGLE + 1)), dtype=np.uint64)


def sketch_limit(n_a: Any, n_b: Any, f: Any = F) -> Any:
    """Most bits in which the sketches of two sets of these sizes differ if their
    similarity is at the threshold; ``f`` has exp and sqrt (columns or numpy).

    With i common elements of u, a bin's smallest hash is common with chance
    i/u. So the samples that differ are, over all bins, those of A and of B
    less twice the common ones. They scatter by bins that hold several
    elements; the bits scatter by samples that fall together.
    """
    j, bins, bits = THRESHOLD_PCT / 100, float(BINS), float(SKETCH_BITS)
    load = (n_a + n_b) / (1 + j) / bins  # of the union
    used = bins * (1 - f.exp(-load))
    differ = bins * (2 - f.exp(-n_a / bins) - f.exp(-n_b / bins)) - 2 * j * used
    shared = 1 - load * bins * f.exp(-load) / used
    by_bins = 2 * f.sqrt(j * (1 - j) * used * shared) * f.exp(-2 * differ / bits)
    x = 4 * differ / bits
    by_bits = f.sqrt(bits / 4 * (1 - f.exp(-x) * (1 + x)))
    return bits / 2 * (1 - f.exp(-2 * differ / bits)) + SIGMAS * f.sqrt(by_bins * by_bins + by_bits * by_bits) + 1


def shingle_sets(t: W.Texts) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes = t.words()
    grams = W.windows(hashes, SHINGLE)
    out = []
    for first, end in zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True):
        if end - first >= SHINGLE:
            out.append(np.unique(grams[first : end - SHINGLE + 1]))
        elif end > first:
            out.append(W.mix(W.windows(hashes[first:end], end - first) + _SALTS[0, end - first]))
        else:
            out.append(hashes[:0])
    return out


def minhash(shingles: np.ndarray) -> np.ndarray:
    low = np.full(SAMPLES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        block = shingles[at : at + _BLOCK]
        np.minimum(low, (_FACTORS[:, None] * block + _OFFSETS[:, None]).min(axis=1), out=low)
    return low


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of the bins' smallest hashes, in bytes."""
    h = np.sort(W.mix(shingles + _SALTS[1, 2]))
    bin_of = h >> np.uint64(64 - (BINS - 1).bit_length())
    samples = h[np.concatenate([[True], bin_of[1:] != bin_of[:-1]])]
    bit = (W.mix(samples + _SALTS[1, 3]) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=SKETCH_BITS).astype(np.uint8) & 1)


def sketch_keys(sets: list[np.ndarray]) -> pa.Array:
    """128-bit key of each set, null for the empty set."""
    keys = [
        np.array([W.mix(s + k).sum(dtype=np.uint64) for k in _SALTS[1, :2]], np.uint64).tobytes() if len(s) else None
        for s in sets
    ]
    return pa.array(keys, pa.binary())


def sketch_texts(t: W.Texts) -> dict:
    """Set size, set key (128 bits), bands and odd sketch of each text."""
    sets = shingle_sets(t)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    samples = np.array([minhash(sets[i]) for i in full], np.uint64).reshape(len(full), SAMPLES)
    bands = np.zeros((len(full), BANDS), np.uint64)
    for r in range(BAND_ROWS):
        bands = W.mix(bands * W.STEP + samples[:, r::BAND_ROWS] + _SALTS[0, :BANDS])
    odd = np.array([odd_sketch(sets[i]) for i in full], np.uint8).reshape(len(full), SKETCH_BITS // 8).view(np.int64)

    def lists(rows: np.ndarray) -> pa.Array:
        width = np.where(sizes > 0, rows.shape[1], 0)
        offsets = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1).view(np.int64)))

    return {"n_shingles": sizes, "set_key": sketch_keys(sets), "bands": lists(bands), "odd": lists(odd)}


SKETCH_FIELDS = {
    "n_shingles": "bigint",
    "set_key": "binary",
    "bands": "array<bigint>",
    "odd": "array<bigint>",
}


def _set_arrays(t: W.Texts) -> dict:
    sets = shingle_sets(t)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return {"set_key": sketch_keys(sets), "shingles": pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))}


def sketch_distance(a: str, b: str) -> Column:
    """Bits in which two odd sketches differ."""
    differing = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda total, x: total + x)


def plausible() -> Column:
    """Sizes and sketches of a pair (a, b) allow the threshold."""
    sizes = 100 * F.least("n_a", "n_b") >= THRESHOLD_PCT * F.greatest("n_a", "n_b")
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    return sizes & (sketch_distance("odd_a", "odd_b") <= sketch_limit(n_a, n_b))


def shareable() -> Column:
    """The shingles that a and b may have in common, at most ``n - own``, allow
    the threshold: i of a union of n_a + n_b - i."""
    most = F.least(F.col("n_a") - F.col("own_a"), F.col("n_b") - F.col("own_b"))
    return (100 + THRESHOLD_PCT) * most >= THRESHOLD_PCT * (F.col("n_a") + F.col("n_b"))


def shingle_table(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of the classes in ``nodes``, made anew from the text of
    one document of each."""
    wanted = written(nodes.distinct().join(classes.select("node", "id", "set_key"), "node"), "wanted")
    texts = docs.join(wanted.select("id").distinct(), "id", "left_semi")
    sets = (
        W.map_texts(texts, "text", _set_arrays, {"set_key": "binary", "shingles": "array<bigint>"})
        .select(F.col("row.id").alias("id"), "set_key", "shingles")
        .join(wanted, ["id", "set_key"])
        .select("node", "shingles")
        .dropDuplicates(["node"])  # the document may have repeated rows
    )
    return written(sets, "sets")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    links = pairs.join(left, "a").join(right, "b").where(100 * common >= THRESHOLD_PCT * union).select("a", "b")
    return written(links, "links")


def own_shingles(sets: DataFrame) -> DataFrame:
    """(node, own): how many shingles no other class of ``sets`` has."""
    return (
        sets.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"), F.max("node").alias("node"))
        .where("n = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )


def first_common_band() -> Column:
    """No band before this one is common to a and b: a pair that shares
    several buckets is made in one of them."""
    before = F.zip_with(
        F.slice("bands_a", 1, F.col("band_a")), F.slice("bands_b", 1, F.col("band_b")), lambda x, y: x != y
    )
    return F.forall(before, lambda differ: differ)


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("bucket", *(F.col(c).alias(f"{c}_{name}") for c in rows.columns if c != "bucket"))


def _with_facts(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs (a, b) with the facts of both."""
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in facts.columns if c != "node")), side)
    return pairs


def _stars(found: DataFrame) -> DataFrame:
    return found.select(F.col("component").alias("a"), F.col("node").alias("b"))


def _mixed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, band, node) rows with their component ``c``, of the buckets that
    hold several."""
    labelled = rows.join(found, "node", "left").select(
        "bucket", "band", "node", F.coalesce("component", "node").alias("c")
    )
    several = labelled.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    return labelled.join(several.select("bucket"), "bucket")


def link_components(shared: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) of the classes with a link, from the (bucket, band,
    node) rows of buckets with several classes; steps 3 to 6."""
    facts = classes.select("node", F.col("n_shingles").alias("n"), "odd")
    spokes = shared.where("node <> star").select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
    pairs = written(_with_facts(spokes, facts).where(plausible()).select("a", "b"), "candidates")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    found = components(confirm(pairs, shingle_table(ends, classes, docs)))

    rest = written(_mixed(shared, found), "mixed")
    if rest.isEmpty():
        return found
    sets = shingle_table(rest.select("node"), classes, docs)
    own = own_shingles(sets)
    facts = facts.join(sets.select("node"), "node").join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    # A class with too many shingles of its own can't link to any other.
    facts = written(facts.where(100 * (F.col("n") - F.col("own")) >= THRESHOLD_PCT * F.col("n")), "facts")
    rest = written(rest.join(facts.select("node", (F.col("own") / F.col("n")).alias("share")), "node"), "able")

    middle = rest.groupBy("bucket").agg(F.min(F.struct("share", "node", "c")).alias("m"))
    spokes = (
        rest.join(middle, "bucket")
        .where("c <> m.c")
        .select(F.least("node", "m.node").alias("a"), F.greatest("node", "m.node").alias("b"))
        .distinct()
    )
    pairs = written(_with_facts(spokes, facts).where(shareable() & plausible()).select("a", "b"), "candidates")
    found = components(_stars(found).union(confirm(pairs, sets)))

    facts = facts.join(classes.select("node", "bands"), "node")
    rest = written(_mixed(rest.select("bucket", "band", "node"), found).join(facts, "node"), "mixed")
    across = _side(rest, "a").join(_side(rest, "b"), "bucket").where(
        (F.col("c_a") < F.col("c_b")) & shareable() & first_common_band() & plausible()
    )
    pairs = across.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return components(_stars(found).union(confirm(written(pairs, "candidates"), sets)))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_column, n_shingles, component_id, kept) for each row of ``docs``."""
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    sketches = written(
        W.map_texts(docs, "text", sketch_texts, SKETCH_FIELDS).select(F.col("row.id").alias("id"), *SKETCH_FIELDS),
        "sketches",
    )
    # One row per set. Equal sets have equal sketches, so any row's will do.
    classes = (
        sketches.where("id is not null and n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min("id").alias("id"),
            F.count(F.lit(1)).alias("n_rows"),
            F.first(F.struct("n_shingles", "bands", "odd")).alias("s"),
        )
        .select("set_key", "id", "n_rows", "s.*")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = written(classes, "classes")
    buckets = classes.select("node", F.posexplode("bands").alias("band", "band_hash")).select(
        F.xxhash64("band", "band_hash").alias("bucket"), "band", "node"
    )
    # Smallest class and whether there are more: combined before the shuffle.
    stars = buckets.groupBy("bucket").agg(F.min("node").alias("star"), F.max("node").alias("last"))
    stars = stars.where("star < last").select("bucket", "star")
    shared = written(buckets.join(stars, "bucket"), "buckets")

    final = link_components(shared, classes, docs)
    labels = classes.join(final, "node", "left").select(
        "set_key", "id", "n_rows", F.coalesce("component", "node").alias("c"), F.col("component").isNotNull().alias("linked")
    )
    smallest = labels.where("linked").groupBy("c").agg(F.min("id").alias("low"))
    # Only classes whose id isn't that of each of their documents are joined.
    moved = (
        labels.where("linked or n_rows > 1")
        .join(smallest, "c", "left")
        .select("set_key", F.coalesce("low", "id").alias("component_id"))
    )
    return (
        sketches.select("id", "n_shingles", "set_key")
        .join(moved, "set_key", "left")
        .select(
            F.col("id").alias(id_column),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
        )
    )
