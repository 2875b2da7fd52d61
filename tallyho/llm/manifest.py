"""Operator 12, a Merkle manifest of a dataset with SHA-256 midstates.

Every row is a leaf, the hash of its fields. Within a group the leaves are ordered
by key, and runs of ``FAN`` neighbours are hashed to a parent until one node, the
group's subroot, is left; the subroots, ordered by group, make the root likewise.

A parent hashes its children one after another, and retains a copy of the hash's
state before each child's slot. Folding a replaced leaf resumes the state of its
slot with the replacement and the siblings to its right only, and goes on with the
parent's digest one level up. Siblings to the left are never hashed again.

On Spark a tree is cut into blocks of ``FAN ** BLOCK_LEVELS`` neighbouring nodes:

1. leaves are hashed in the JVM and numbered in their group, in pieces, so a group
   may hold any share of the rows; only digests are shuffled, never texts;
2. going up, one task makes the top node of each block; the tops are the next
   round's nodes, until every group has one node. The groups' tree is made alike;
3. going down, each block gives the nodes under it their way to the root: for
   each level above, the siblings on both sides;
4. at the bottom a block's task builds the parents with their midstates, opens the
   midstates of the way above once, and folds each of the block's rows.

A task holds one block and its way up, whatever the data; there are as many
rounds as powers of the block size.

Defined results: null fields are ``-``; a null key comes first and a null group is
a group, the first. Rows of equal key are ordered by their leaf, repeated rows are
leaves each. An empty table gives no rows. Long texts are hashed whole. Input
columns may have any names: ``fields``, ``key`` and ``group`` name those that are read,
and ``keep`` those that come back, in one struct, ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.operators.running import row_index
from tallyho.session import configure

from .store import written

FAN = 8
#: Levels of a block: 8 ** 4 = 4096 nodes at most.
BLOCK_LEVELS = 4

Level = list["Parent"]
#: A level of a node's way up: the digests left and right of it.
Step = tuple[str, str]
_STEPS = "array<struct<left:string,right:string>>"


# --- one block --------------------------------------------------------------


class Parent:
    """An inner node: its children's digests, the hash state before each of
    them, and its own digest."""

    __slots__ = ("children", "digest", "states")

    def __init__(self, children: Sequence[str]):
        state = hashlib.sha256()
        self.children, self.states = children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def step(self, slot: int) -> Step:
        return "".join(self.children[:slot]), "".join(self.children[slot + 1 :])

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with another child in ``slot``."""
        return resumed(self.states[slot], replacement, "".join(self.children[slot + 1 :]))


def resumed(state: Any, replacement: str, right: str) -> str:
    state = state.copy()
    state.update((replacement + right).encode())
    return state.hexdigest()


def opened(left: str) -> Any:
    """The state before the slot behind ``left``."""
    return hashlib.sha256(left.encode())


def build(nodes: Sequence[str], levels: int) -> list[Level]:
    """``levels`` levels of parents above neighbouring nodes."""
    out: list[Level] = []
    for _ in range(levels):
        out.append([Parent(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in out[-1]]
    return out


def steps_of(tree: list[Level], place: int) -> list[Step]:
    """The way of a node from the bottom of a block to its top."""
    out = []
    for level in tree:
        place, slot = divmod(place, FAN)
        out.append(level[place].step(slot))
    return out


def levels_of(block: int, n_nodes: int) -> int:
    """Levels of a block with ``n_nodes`` nodes at its bottom: all, or, where it isn't
    full and no other stands beside it, as many as leave one node."""
    levels = 0
    while levels < BLOCK_LEVELS and (block or n_nodes > 1):
        n_nodes, levels = -(-n_nodes // FAN), levels + 1
    return levels


# --- leaves -----------------------------------------------------------------


def field_bytes(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of a row's fields, each with its length in front."""
    return F.sha2(F.concat(*map(field_bytes, fields)), 256)


# --- the trees of all groups ------------------------------------------------

_SIZE = FAN**BLOCK_LEVELS


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {_SIZE}"))


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def _tops(nodes: DataFrame) -> DataFrame:
    """(grp, idx, digest) of blocks of (grp, idx, digest) nodes."""
    schema = "grp string, idx bigint, digest string"
    shape = _arrow_schema(schema)

    def top(block: pa.Table) -> pa.Table:
        rows = sorted(zip(block["idx"].to_pylist(), block["digest"].to_pylist(), strict=True))
        own = rows[0][0] // _SIZE
        tree = build([d for _, d in rows], levels_of(own, len(rows)))
        digest = tree[-1][0].digest if tree else rows[0][1]
        return pa.Table.from_pylist([{"grp": block["grp"][0].as_py(), "idx": own, "digest": digest}], shape)

    return _in_blocks(nodes).groupBy("grp", "block").applyInArrow(top, schema)


def _ways(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, idx, steps, subroot, root) of nodes, from (grp, idx, steps, subroot, root) of
    their blocks."""
    schema = f"grp string, idx bigint, steps {_STEPS}, subroot string, root string"
    shape = _arrow_schema(schema)

    def way(block: pa.Table, up: pa.Table) -> pa.Table:
        rows = sorted(zip(block["idx"].to_pylist(), block["digest"].to_pylist(), strict=True))
        tree = build([d for _, d in rows], levels_of(rows[0][0] // _SIZE, len(rows)))
        higher = up.to_pylist()[0]
        made = []
        for k, (idx, _) in enumerate(rows):
            own = [{"left": a, "right": b} for a, b in steps_of(tree, k)]
            made.append(higher | {"idx": idx, "steps": own + higher["steps"]})
        return pa.Table.from_pylist([{f: r[f] for f in shape.names} for r in made], shape)

    blocks = _in_blocks(nodes).groupBy("grp", "block")
    return blocks.cogroup(above.withColumn("block", F.col("idx")).groupBy("grp", "block")).applyInArrow(way, schema)


def _up(nodes: DataFrame, tag: str) -> list[DataFrame]:
    """The rounds of nodes, the last with one node in each group."""
    rounds = [nodes]
    while not rounds[-1].where("idx > 0").isEmpty():
        rounds.append(written(_tops(rounds[-1]), tag))
    return rounds


def _down(rounds: list[DataFrame], ways: DataFrame, tag: str) -> DataFrame:
    """Ways of the nodes of the first of the rounds, from those of the last one's
    blocks (themselves, if there are no rounds)."""
    for nodes in reversed(rounds):
        ways = written(_ways(nodes, ways), tag)
    return ways


def _group_name(group: Column) -> Column:
    """Groups as text in their order: null first, then by value."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def _numbered(rows: DataFrame, order: Sequence[str], tag: str) -> DataFrame:
    """With each row's place ``idx`` in its group, from 0."""
    numbered = row_index(rows, ["grp"], order, "idx")
    return written(numbered.withColumn("idx", F.col("idx") - 1), tag)


def build_manifest(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (grp, key, digest, replacement, ...): the rows with their place ``idx`` in
    the group; and (grp, idx, steps, subroot, root) of their blocks."""
    placed = _numbered(leaves, ["key", "digest", "replacement"], "manifest-leaves")
    rounds = _up(placed.select("grp", "idx", "digest"), "manifest-nodes")
    # The groups' tree: one node for each group, in one group of its own.
    subroots = rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("own"), "digest")
    numbered = _numbered(subroots, ["own"], "manifest-groups")
    top_rounds = _up(numbered.select("grp", "idx", "digest"), "manifest-top")
    none = F.array().cast(_STEPS).alias("steps")
    root = top_rounds[-1].select("grp", "idx", none, F.lit("").alias("subroot"), F.col("digest").alias("root"))
    ways = _down(top_rounds[:-1], root, "manifest-top-ways")
    of_groups = numbered.join(ways.drop("grp", "subroot"), "idx").select(
        F.col("own").alias("grp"), F.lit(0).cast("bigint").alias("idx"), "steps", F.col("digest").alias("subroot"), "root"
    )
    return placed, _down(rounds[1:-1], written(of_groups, "manifest-group-ways"), "manifest-ways")


def fold(placed: DataFrame, ways: DataFrame) -> DataFrame:
    """The rows of :func:`build_manifest` with (subroot, root, proof, folded_root):
    ``proof`` is the hash of the siblings on a row's way up, ``folded_root`` the
    root with the row's ``replacement`` in its leaf's place."""
    kept = [f.name for f in placed.schema if f.name not in ("idx", "grp")]
    added = ("subroot", "root", "proof", "folded_root")
    schema = T.StructType([*(placed.schema[c] for c in kept), *(T.StructField(c, T.StringType()) for c in added)])

    def run(block: pa.Table, up: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        way = up.to_pylist()[0]
        tree = build(block["digest"].to_pylist(), levels_of(block["block"][0].as_py(), block.num_rows))
        above = [(opened(s["left"]), s["right"]) for s in way["steps"]]
        siblings = "".join(s["left"] + s["right"] for s in way["steps"])
        proofs, folded = [], []
        for place, now in enumerate(block["replacement"].to_pylist()):
            seen = []
            for level in tree:
                place, slot = divmod(place, FAN)
                seen += level[place].step(slot)
                now = level[place].fold(slot, now)
            for state, right in above:
                now = resumed(state, now, right)
            proofs.append(hashlib.sha256(("".join(seen) + siblings).encode()).hexdigest())
            folded.append(now)
        out = block.select(kept)
        for name, column in (
            ("subroot", [way["subroot"]] * len(folded)),
            ("root", [way["root"]] * len(folded)),
            ("proof", proofs),
            ("folded_root", folded),
        ):
            out = out.append_column(name, pa.array(column, pa.string()))
        return out

    blocks = _in_blocks(placed).groupBy("grp", "block")
    return blocks.cogroup(ways.withColumn("block", F.col("idx")).groupBy("grp", "block")).applyInArrow(run, schema)


def manifest(
    rows: DataFrame,
    fields: Sequence[str],
    key: str,
    group: str,
    changed: Column | None = None,
    replaced: dict[str, Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(row, leaf, replacement, subroot, root, proof, folded_root) of every row.

    Where ``changed`` holds, the leaf of the row with the values of ``replaced`` is
    folded into the tree in the row's place, elsewhere the row's own.
    """
    configure(rows.sparkSession)
    column = lambda c: F.col("`" + c.replace("`", "``") + "`")
    own = leaf([column(c) for c in fields])
    new = leaf([(replaced or {}).get(c, column(c)) for c in fields])
    leaves = rows.select(
        F.struct(*(column(c) for c in keep or (key,))).alias("row"),
        _group_name(column(group)).alias("grp"),
        column(key).alias("key"),
        own.alias("digest"),
        (own if changed is None else F.when(changed, new)).alias("new"),
    ).select("row", "grp", "key", "digest", F.coalesce("new", "digest").alias("replacement"))
    placed, ways = build_manifest(written(leaves, "manifest-hashed"))
    return fold(placed, ways).withColumnRenamed("digest", "leaf").drop("key")


def verified(manifest_rows: DataFrame) -> DataFrame:
    """With ``verified``: whether the folded root is the root."""
    return manifest_rows.withColumn("verified", F.col("folded_root") == F.col("root"))
