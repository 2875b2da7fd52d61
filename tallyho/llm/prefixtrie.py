"""Operator 11, a prefix trie of conversations in adaptive radix trees.

A turn is its role and text; its id is 16 bytes (MD5, so different turns get
different ids), and a conversation's key is the ids of its turns in order, big-endian. In
a task an adaptive radix tree holds keys: a node's children are in one of four
layouts (4, 16, 48, 256 places) that grows as they get more, and a run of bytes
without a branch is one compressed path. Only byte depths at whole turns make trie
nodes, so a path may make several nodes and most branches make none.

On Spark only ids and lengths are shuffled, never texts:

1. turns are numbered in their conversation, in pieces, so one conversation may
   hold any share of the rows; keys are cut into segments of ``SEGMENT`` turns. A segment
   hangs from the node of all turns before it, known by a sum of segment hashes;
2. segments are range-partitioned by key. A task's trees hold ``HELD_BYTES`` at most
   and then hand on their nodes: id, members, smallest member. Equal nodes of
   several trees are summed by id (the first and last paths of a task at most,
   and what a full tree had to hand on);
3. sums over subtrees. The nodes with one smallest member are the lower end of its
   path, a chain, and every node is in one chain. So a node's sum is that of its own
   chain from it downwards, and of all of each chain that begins below it. The
   latter are summed by the trees again: a chain's key down to the node above it
   is inserted with the chain's sums;
4. the members that end at a node are hashed in order, in a stream that holds
   one hash state, from lists of at most ``END_CHUNK`` ids.

Defined results: a null role or text is empty. Turns are ordered by number, null
first, those of one number by role and then by id, so repeated rows are turns each.
Rows without a conversation id belong to none and are left out. A conversation
without turns ends at the root. An empty table has no nodes. Texts of any length
count their code points. Other columns of the input are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.operators.running import row_index, running_sum
from tallyho.session import configure

from .store import written

#: Bytes of a turn's id.
WIDTH = 16
#: Turns of a segment of a key.
SEGMENT = 1024
#: Bytes of keys that a task's tree holds before it hands on its nodes.
HELD_BYTES = 16_000_000
#: Members in one piece of a node's list.
END_CHUNK = 10_000
_OUT_ROWS = 20_000
_ENTRY_BYTES = 200  # of a key in a tree, besides the key


# --- the tree ---------------------------------------------------------------


class Few:
    """Up to ``places`` children beside their bytes: the layouts 4 and 16."""

    __slots__ = ("bytes", "nodes", "places")

    def __init__(self, places: int):
        self.places, self.bytes, self.nodes = places, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> bool:
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
        elif len(self.nodes) == self.places:
            return False
        else:
            self.bytes.append(byte)
            self.nodes.append(node)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children, found by an index of all bytes."""

    __slots__ = ("index", "nodes")
    places = 48

    def __init__(self) -> None:
        self.index, self.nodes = bytearray(b"\xff") * 256, []

    def get(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.nodes[at] if at != 0xFF else None

    def put(self, byte: int, node: Node) -> bool:
        at = self.index[byte]
        if at != 0xFF:
            self.nodes[at] = node
        elif len(self.nodes) == self.places:
            return False
        else:
            self.index[byte] = len(self.nodes)
            self.nodes.append(node)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[at]) for b, at in enumerate(self.index) if at != 0xFF)


class Full:
    """A place for every byte."""

    __slots__ = ("nodes",)
    places = 256

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> bool:
        self.nodes[byte] = node
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


_GROWN: dict[int, Callable] = {4: lambda: Few(16), 16: Indexed, 48: Full}


class Node:
    """Bytes ``begin`` to ``end`` of ``key`` lead to it without a branch; ``key`` is one of the
    keys below it, ``mark`` what came with that key. ``a``, ``b`` and ``low`` are of the keys
    that end here."""

    __slots__ = ("a", "b", "begin", "children", "end", "key", "low", "mark")

    def __init__(self, key: bytes, mark: object, begin: int, end: int):
        self.key, self.mark, self.begin, self.end = key, mark, begin, end
        self.children: Few | Indexed | Full | None = None
        self.a, self.b, self.low = 0, 0, None

    def add(self, a: int, b: int, low: int | None) -> None:
        self.a += a
        self.b += b
        if low is not None:
            self.low = low if self.low is None else min(self.low, low)

    def put(self, byte: int, child: Node) -> None:
        if self.children is None:
            self.children = Few(4)
        if not self.children.put(byte, child):
            grown = _GROWN[self.children.places]()
            for b, n in self.children.items():
                grown.put(b, n)
            grown.put(byte, child)
            self.children = grown


def _common(x: bytes, y: bytes, begin: int, end: int) -> int:
    """Where two keys that agree before ``begin`` part, ``end`` at most."""
    end = min(end, len(x), len(y))
    if x[begin:end] == y[begin:end]:
        return end
    while end - begin > 1:
        half = (begin + end) // 2
        if x[begin:half] == y[begin:half]:
            begin = half
        else:
            end = half
    return begin


class Tree:
    """An adaptive radix tree of byte keys with sums."""

    def __init__(self) -> None:
        self.root = Node(b"", None, 0, 0)
        self.size = 0

    def insert(self, key: bytes, mark: object, a: int, b: int, low: int | None) -> None:
        self.size += len(key) + _ENTRY_BYTES
        node = self.root
        while True:
            at = node.end
            if at == len(key):
                node.add(a, b, low)
                return
            child = node.children.get(key[at]) if node.children is not None else None
            if child is None:
                leaf = Node(key, mark, at, len(key))
                leaf.add(a, b, low)
                node.put(key[at], leaf)
                return
            part = _common(child.key, key, at, child.end)
            if part < child.end:  # the path branches, or a key ends on it
                upper = Node(child.key, child.mark, at, part)
                upper.put(child.key[part], child)
                child.begin = part
                node.put(key[at], upper)
                child = upper
            node = child

    def nodes(self) -> Iterator[tuple[Node, int, int, int | None]]:
        """(node, sums of a and b, smallest low) over the keys at and below each
        node, children first."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            if node.children is not None:
                stack += [n for _, n in node.children.items()]
        sums: dict[int, tuple[int, int, int | None]] = {}
        for node in reversed(order):
            a, b, low = node.a, node.b, node.low
            if node.children is not None:
                for _, child in node.children.items():
                    more = sums.pop(id(child))
                    a, b = a + more[0], b + more[1]
                    if more[2] is not None:
                        low = more[2] if low is None else min(low, more[2])
            sums[id(node)] = a, b, low
            yield node, a, b, low


# --- ids of trie nodes ------------------------------------------------------


def _segment_hash(segment: int, key: bytes) -> int:
    return int(hashlib.md5(f"{segment}|".encode() + key).hexdigest()[:24], 16)


def _segment_hash_column(segment: Column, key: Column) -> Column:
    whole = F.md5(F.concat(F.encode(F.concat(segment.cast("string"), F.lit("|")), "UTF-8"), key))
    part = lambda at: F.conv(F.substring(whole, at, 12), 16, 10).cast("decimal(15,0)")
    return (part(1) * F.lit(1 << 48).cast("decimal(15,0)") + part(13)).cast("decimal(38,0)")


class Place:
    """Where a tree hangs: its keys' segment number, and the sum of the hashes
    of the segments before."""

    def __init__(self, segment: int, before: str):
        self.segment, self.before = segment, int(before)
        self.base = f"{segment}|{self.before}".encode()

    def ids(self, key: bytes, first: int, last: int) -> list[bytes]:
        """Ids of the nodes after ``first`` to ``last`` turns of a key."""
        state = hashlib.md5(self.base + key[: first * WIDTH])
        out = []
        for depth in range(first, last + 1):
            if depth > first:
                state.update(key[(depth - 1) * WIDTH : depth * WIDTH])
            if depth == SEGMENT:  # the root of what hangs below
                after = self.before + _segment_hash(self.segment, key[: SEGMENT * WIDTH])
                out.append(Place(self.segment + 1, str(after)).ids(b"", 0, 0)[0])
            else:
                out.append(state.digest())
        return out


def trie_nodes(tree: Tree, place: Place) -> Iterator[tuple]:
    """(id, parent's id, turns in the segment, mark, a, b, low) of the turn-aligned
    depths of a tree. The root of a lower segment is left to the tree above."""
    for node, a, b, low in tree.nodes():
        if node is tree.root:
            if not place.segment:
                yield place.ids(b"", 0, 0)[0], None, 0, None, a, b, low
            continue
        first, last = node.begin // WIDTH + 1, node.end // WIDTH
        if first <= last:
            ids = place.ids(node.key, first - 1, last)
            for k in range(first, last + 1):
                yield ids[k - first + 1], ids[k - first], k, node.mark, a, b, low


# --- on DataFrames ----------------------------------------------------------


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, tid, size): each turn's place in its conversation from 1, its id, and the
    code points of its text."""
    configure(conversations.sparkSession)
    name = F.coalesce(F.col(role), F.lit(""))
    said = F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        name.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name, said))).alias("tid"),
        F.length(said).alias("size"),
    )
    return row_index(rows, ["conv"], ["turn", "role", "tid"], "pos").select("conv", "pos", "tid", "size")


def with_heads(own: DataFrame, head: Column, source: Column) -> DataFrame:
    """The turns of conversations that begin with the first ``head`` turns of another
    one, ``source``, and go on with their own after as many; both are expressions of
    ``conv``. ``head`` is small: it bounds the turns that are copied for a conversation."""
    convs = own.where("pos = 1").select("conv", source.alias("source"), head.alias("head"))
    firsts = own.select(F.col("conv").alias("of"), "pos", "tid", "size")
    most = convs.agg(F.max("head")).first()[0] or 0  # one number
    copied = convs.join(firsts.where(F.col("pos") <= most), (F.col("source") == F.col("of")) & (F.col("pos") <= F.col("head")))
    rest = own.where(F.col("pos") > head)
    return copied.select("conv", F.lit(1).alias("part"), "pos", "tid", "size").unionByName(
        rest.select("conv", F.lit(2).alias("part"), "pos", "tid", "size")
    )


def segments(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, segment, key, sizes, last, before) of (conv, part, pos, tid, size) turns of
    all (conv): keys cut into segments, and the sum of the hashes before each."""
    ends = convs.select("conv", F.lit(3).alias("part"), F.lit(0).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("tid"), F.lit(0).alias("size"))
    numbered = row_index(rows.unionByName(ends), ["conv"], ["part", "pos"], "at")
    one = F.struct("at", "tid", "size")
    cut = (
        numbered.groupBy("conv", F.expr(f"(at - 1) div {SEGMENT}").alias("segment"))
        .agg(F.array_sort(F.collect_list(F.when(F.col("tid").isNotNull(), one))).alias("t"), F.max(F.col("tid").isNull()).alias("last"))
        .select(
            "conv",
            "segment",
            F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["tid"])), "")).alias("key"),
            F.transform("t", lambda x: x["size"]).alias("sizes"),
            "last",
        )
    )
    own = cut.withColumn("hash", _segment_hash_column(F.col("segment"), F.col("key")))
    upto = running_sum(own, ["conv"], ["segment"], "hash", "upto")
    return upto.select("conv", "segment", "key", "sizes", "last", (F.col("upto") - F.col("hash")).cast("string").alias("before"))


_NODE = "kind int, id binary, parent binary, depth bigint, size bigint, a bigint, b bigint, low bigint, ends string"


def _in_trees(rows: DataFrame, with_ends: bool) -> DataFrame:
    """Nodes of trees of (segment, before, key, sizes, a, b, low, conv, last) rows, some of
    them in parts; with ``with_ends`` also, as kind 1, lists of the ``conv`` that end at a
    node (low: the first of a list)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    shape = to_arrow_schema(_parse_datatype_string(_NODE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        tree, place, group = Tree(), None, None
        ending: tuple | None = None
        convs: list[int] = []

        def made() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)
            out.clear()
            return batch

        def hand_on() -> Iterator[pa.RecordBatch]:
            nonlocal tree
            if place is not None and tree.size:
                begin = place.segment * SEGMENT
                for id_, parent, k, sizes, a, b, low in trie_nodes(tree, place):
                    out.append((0, id_, parent, begin + k, sizes[k - 1] if sizes and k else 0, a, b, low, None))
                    if len(out) >= _OUT_ROWS:
                        yield made()
            tree = Tree()

        def close_ends() -> None:
            if convs:
                key = ending[1]
                id_ = place.ids(key, len(key) // WIDTH, len(key) // WIDTH)[0]
                out.append((1, id_, None, None, None, None, None, convs[0], ",".join(map(str, convs))))
                convs.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if (r["segment"], r["before"]) != group:
                    close_ends()
                    yield from hand_on()
                    group = r["segment"], r["before"]
                    place = Place(*group)
                elif tree.size >= HELD_BYTES:
                    yield from hand_on()
                tree.insert(r["key"], r["sizes"], r["a"], r["b"], r["low"])
                if with_ends and r["last"]:
                    if ending != (group, r["key"]) or len(convs) >= END_CHUNK:
                        close_ends()
                        ending = group, r["key"]
                    convs.append(r["conv"])
                if len(out) >= _OUT_ROWS:
                    yield made()
        close_ends()
        yield from hand_on()
        if out:
            yield made()

    order = ["segment", "before", "key", "conv"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _NODE)


def ends_hashes(lists: DataFrame) -> DataFrame:
    """(id, ends_sha256) of (id, low, ends): the lists of an id, in the order of their first
    members, joined by commas and hashed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for id_, ends in zip(batch["id"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if id_ == now:
                    state.update(b"," + ends.encode())
                else:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = id_, hashlib.sha256(ends.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["id", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["id", "ends_sha256"])

    sorted_ = lists.select("id", "low", "ends").repartition("id").sortWithinPartitions("id", "low")
    return sorted_.mapInArrow(run, "id binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv, part, pos, tid, size) turns of all (conv): (conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    cut = written(segments(rows, convs), "trie-segments")
    count = lambda x: F.lit(x).cast("bigint")
    found = written(
        _in_trees(cut.withColumns({"a": count(1), "b": count(0), "low": F.col("conv")}), True), "trie-parts"
    )
    nodes = written(
        found.where("kind = 0")
        .groupBy("id")
        .agg(
            F.max("parent").alias("parent"),
            F.max("depth").alias("depth"),
            F.max("size").alias("size"),
            F.sum("a").alias("n_convs"),
            F.min("low").alias("conv_id"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    valued = nodes.join(children, F.col("id") == F.col("of"), "left").select(
        *nodes.columns,
        F.coalesce("n_children", count(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    # A chain: the nodes with one smallest member. Only its last can be childless.
    chained = written(
        running_sum(
            valued,
            ["conv_id"],
            ["depth"],
            "saved",
            "saved_upto",
            {"top": F.min("depth"), "leaves": F.max((F.col("n_children") == 0).cast("bigint")), "total": F.sum("saved")},
        ),
        "trie-chains",
    )
    chains = chained.where(F.col("depth") == F.col("top")).select(
        F.col("conv_id").alias("of"), "top", F.col("leaves").alias("a"), F.col("total").alias("b")
    )
    above = F.least(F.col("top") - 1 - F.col("segment") * SEGMENT, F.lit(SEGMENT))
    hung = (
        cut.join(chains, F.col("conv") == F.col("of"))
        .withColumn("above", above)
        .where("above > 0 or above = 0 and segment = 0")
        .select("segment", "before", F.expr(f"substring(key, 1, cast(above as int) * {WIDTH})").alias("key"), "a", "b", "conv")
        .withColumns({"sizes": F.lit(None).cast("array<int>"), "low": F.lit(None).cast("bigint"), "last": F.lit(False)})
    )
    below = (
        _in_trees(written(hung, "trie-hung"), False)
        .groupBy(F.col("id").alias("below_id"))
        .agg(F.sum("a").alias("below_leaves"), F.sum("b").alias("below_saved"))
    )
    ends = ends_hashes(found.where("kind = 1")).withColumnRenamed("id", "ends_id")
    parents = nodes.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    return (
        chained.join(below, F.col("id") == F.col("below_id"), "left")
        .join(ends, F.col("id") == F.col("ends_id"), "left")
        .join(parents, F.col("parent") == F.col("parent_id"), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("leaves") + F.coalesce("below_leaves", count(0))).alias("n_leaves"),
            (F.col("total") - F.col("saved_upto") + F.col("saved") + F.coalesce("below_saved", count(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
