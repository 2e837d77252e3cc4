"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation is a sequence of turns; a turn is its role and text, held as a 16-byte digest and
the UTF-8 bytes of its text. Every distinct beginning of a sequence is a node of the trie; the
sequences that start with it are its members.

1. Equal sequences become one class (smallest id, number of ids). The ids that end at a node are
   hashed in ascending order: grouped into sorted chunks of bounded size first, which are then
   streamed through one digest, so a sequence shared by very many ids is never held as a whole.
2. The classes are sorted by their digests, in range partitions. Neighbours i and i + 1 are joined
   by an edge whose depth is their longest common prefix (LCP).
3. *Union-find, deepest edges first*, in blocks of neighbours: before a merge at depth l both
   components climb to depth l + 1, which yields the nodes of their unbranched stretches; the
   merge makes the branching node at depth l (or adds to the one that is there).
4. *Contraction*: in a block only beginnings of its first and last sequence can have members
   elsewhere. All other nodes are finished; the block shrinks to these two sequences, which carry
   what hangs from each of their nodes. They are the items of the next, much shorter level,
   sorted and merged in the same way, until one block holds all.
5. A finished node whose parent was not finished then gets its parent's smallest member by a join
   with the few nodes of the later levels.

A node's numbers are sums and minima over its members and its subtree, so the order of merging
does not matter.

Turns are ordered by turn number, nulls first, equal numbers by digest and bytes; repeated rows
are separate turns. Null role or text is empty. Rows with a null conversation id take no part.
An empty sequence is a member of the root only. Without conversations there is no root. A row
holds one conversation's digests: 16 bytes and a length a turn, no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import setup, text_or_empty, written

DIGEST = 16
CHUNK_BITS = 12  # 4096 ids of one class at most are hashed as one row
BLOCK_ITEMS = 8192  # sequences of one union-find
BROADCAST_NODES = 500_000
EMPTY = hashlib.sha256(b"").hexdigest()


def common_depth(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common at the beginning."""
    lo, hi = 0, min(len(a), len(b)) // DIGEST
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * DIGEST : mid * DIGEST] == b[lo * DIGEST : mid * DIGEST]:
            lo = mid
        else:
            hi = mid - 1
    return lo


@dataclass
class Load:
    """What belongs to one node: members that end here or below in finished subtrees, finished children
    and the sums of their subtrees."""

    convs: int = 0
    low: int | None = None
    kids: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None

    def add(self, other: Load) -> None:
        self.convs += other.convs
        if other.low is not None:
            self.low = other.low if self.low is None else min(self.low, other.low)
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends


@dataclass
class Item:
    """A sequence and what hangs from its nodes, by depth."""

    path: bytes
    sizes: list[int]  # bytes of the text of every turn
    loads: dict[int, Load]

    @property
    def depth(self) -> int:
        return len(self.path) // DIGEST


@dataclass
class Node:
    conv: int
    depth: int
    n_convs: int
    n_children: int
    n_leaves: int
    saved: int
    ends: str
    key: bytes | None = None  # names the node for children of earlier levels
    parent: int | None = None
    parent_key: bytes | None = None


@dataclass
class _Component:
    """Items with a common beginning, seen from the node at ``depth``."""

    item: int  # any of its items
    depth: int
    outer: bool  # holds the block's first or last item: its nodes may have members elsewhere
    loads: dict[int, Load]  # at depths up to ``depth``
    below: list[Node] = field(default_factory=list)  # finished children of the node at ``depth``


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.blake2b(path[: depth * DIGEST], digest_size=DIGEST).digest()


class Forest:
    """One block of sorted items."""

    def __init__(self, items: list[Item], last_level: bool, named: bool):
        self.items, self.named = items, named
        self.nodes: list[Node] = []
        self.ends = (0, len(items) - 1)
        self.open: dict[int, dict[int, Load]] = {i: {} for i in self.ends}
        self.parts = [
            _Component(i, item.depth, not last_level and i in self.ends, item.loads) for i, item in enumerate(items)
        ]
        self.parent = list(range(len(items)))
        edges = [(common_depth(items[i].path, items[i + 1].path), i) for i in range(len(items) - 1)]
        for depth, i in sorted(edges, key=lambda e: -e[0]):
            self._merge(self._find(i), self._find(i + 1), depth)
        self._climb(self.parts[self._find(0)], -1)

    def _find(self, i: int) -> int:
        top = i
        while self.parent[top] != top:
            top = self.parent[top]
        while self.parent[i] != top:
            self.parent[i], i = top, self.parent[i]
        return top

    def _merge(self, a: int, b: int, depth: int) -> None:
        one, two = self.parts[a], self.parts[b]
        self._climb(one, depth)
        self._climb(two, depth)
        if len(one.below) + len(one.loads) < len(two.below) + len(two.loads):
            a, b, one, two = b, a, two, one
        for d, load in two.loads.items():
            if d in one.loads:
                one.loads[d].add(load)
            else:
                one.loads[d] = load
        one.below.extend(two.below)
        if two.outer:
            # Named by an outer item: its path is the one that goes on.
            one.item, one.outer = (min(one.item, two.item) if one.outer else two.item), True
        self.parent[b] = a

    def _climb(self, part: _Component, depth: int) -> None:
        """Finish (or, for outer components, hand on) the nodes below ``depth``."""
        while part.depth > depth:
            (self._hand_on if part.outer else self._finish)(part)
            part.depth -= 1

    def _finish(self, part: _Component) -> None:
        depth, item = part.depth, self.items[part.item]
        load = part.loads.pop(depth)
        size = item.sizes[depth - 1] if depth else 0
        node = Node(load.low, depth, load.convs, load.kids, load.leaves if load.kids else 1,
                    load.saved + (load.convs - 1) * size, load.ends or EMPTY)
        if self.named:
            node.key = _key(item.path, depth)
        for child in part.below:
            child.parent = node.conv
        self.nodes.append(node)
        part.below = [node]
        if depth:
            up = Load(load.convs, load.low, 1, node.n_leaves, node.saved)
            part.loads.setdefault(depth - 1, Load()).add(up)

    def _hand_on(self, part: _Component) -> None:
        depth, item = part.depth, self.items[part.item]
        load = part.loads.pop(depth, None)
        if part.below:
            key = _key(item.path, depth)
            for child in part.below:
                child.parent_key = key
            part.below = []
        if load is not None:
            end = part.item if part.item in self.ends else self.ends[0]
            self.open[end].setdefault(depth, Load()).add(load)

    def contracted(self) -> list[Item]:
        """The first and the last item, with what hangs from their nodes."""
        return [Item(self.items[i].path, self.items[i].sizes, self.open[i]) for i in sorted(set(self.ends))]


# ---- Spark stages -------------------------------------------------------------------------

ITEM_FIELDS = (
    "path binary, sizes array<bigint>, "
    "loads array<struct<depth:bigint,convs:bigint,low:bigint,kids:bigint,leaves:bigint,saved:bigint,ends:string>>"
)
NODE_FIELDS = (
    "conv bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string, "
    "key binary, parent bigint, parent_key binary"
)
_LOAD = pa.struct([(n, pa.int64()) for n in ("depth", "convs", "low", "kids", "leaves", "saved")] + [("ends", pa.string())])
_ITEMS = pa.schema([("path", pa.binary()), ("sizes", pa.list_(pa.int64())), ("loads", pa.list_(_LOAD))])
_NODES = pa.schema(
    [(n, pa.int64()) for n in ("conv", "depth", "n_convs", "n_children", "n_leaves", "saved")]
    + [("ends", pa.string()), ("key", pa.binary()), ("parent", pa.int64()), ("parent_key", pa.binary())]
)
_OUT = pa.schema([*_NODES, *_ITEMS])


def turn_digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.md5(role.cast("binary")), text).cast("binary"))


def sequences(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv, turns``: the turns of each conversation in order, as digest and bytes."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    turn = F.struct(
        F.col(turn_col).alias("turn"), turn_digest(role, text).alias("digest"), F.octet_length(text).cast("bigint").alias("size")
    )
    rows = conversations.select(F.col(id_col).cast("bigint").alias("conv"), turn.alias("turn")).filter("conv is not null")
    grouped = rows.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv", F.transform("turns", lambda t: F.struct(t["digest"], t["size"])).alias("turns"))


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by class and place to one row per class; a chunk is held at a time."""
    held = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held is not None and held["key"] == row["key"]:
                held["sha"].update(b",")
                held["n"] += row["n"]
            else:
                if held is not None:
                    out.append(held)
                held = row | {"sha": hashlib.sha256()}
            held["sha"].update(row["ids"].encode())
        yield _class_rows(out)
    if held is not None:
        yield _class_rows([held])


def _class_rows(rows: list[dict]) -> pa.RecordBatch:
    loads = [
        [{"depth": len(r["path"]) // DIGEST, "convs": r["n"], "low": r["low"], "kids": 0, "leaves": 0, "saved": 0,
          "ends": r["sha"].hexdigest()}]
        for r in rows
    ]
    values = [[r["path"] for r in rows], [r["sizes"] for r in rows], loads]
    return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(values, _ITEMS, strict=True)], schema=_ITEMS)


def classes(found: DataFrame) -> DataFrame:
    """One item per distinct sequence of ``conv, turns``; every ``conv`` is there once."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = found.select("conv", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    chunk = F.shiftright("conv", CHUNK_BITS)
    grouped = rows.groupBy(F.sha2("path", 256).alias("key"), chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list("conv")).alias("ids"), F.first("path").alias("path"), F.first("sizes").alias("sizes")
    )
    ids = F.array_join("ids", ",")
    grouped = grouped.select(
        "key", "chunk", "path", "sizes", F.size("ids").cast("bigint").alias("n"), F.get("ids", F.lit(0)).alias("low"), ids.alias("ids")
    )
    return grouped.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(_hashed_ends, ITEM_FIELDS)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[Item]:
    for batch in batches:
        for row in batch.to_pylist():
            loads = {x.pop("depth"): Load(**x) for x in row["loads"]}
            yield Item(row["path"], row["sizes"], loads)


def _merger(last_level: bool, named: bool, block: int):
    def out(forest: Forest) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(forest.nodes), 20_000):
            some = forest.nodes[at : at + 20_000]
            columns = [pa.array([getattr(n, f.name) for n in some], f.type) for f in _NODES]
            columns += [pa.nulls(len(some), f.type) for f in _ITEMS]
            yield pa.RecordBatch.from_arrays(columns, schema=_OUT)
        if last_level:
            return
        items = forest.contracted()
        values = [
            [i.path for i in items],
            [i.sizes for i in items],
            [[{"depth": d} | vars(x) for d, x in sorted(i.loads.items())] for i in items],
        ]
        columns = [pa.nulls(len(items), f.type) for f in _NODES]
        columns += [pa.array(v, f.type) for v, f in zip(values, _ITEMS, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Item] = []
        for item in _items(batches):
            held.append(item)
            if len(held) == block and not last_level:
                yield from out(Forest(held, last_level, named))
                held = []
        if held:
            yield from out(Forest(held, last_level, named))

    return run


def trie(found: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """``conv, depth, parent, n_convs, n_children, n_leaves, saved, ends`` of every node.

    ``found`` has one row per conversation: ``conv`` and ``turns`` (as from ``sequences``).
    """
    setup(found.sparkSession)
    if block < 3:
        raise ValueError("a block of less than three items does not shrink")
    items = written(classes(found), "trie-items")
    levels: list[DataFrame] = []
    n = items.count()
    while not levels or n:
        last_level = n <= block
        # The last level is one block of at most ``block`` items; before that, ranges of the sorted order.
        ordered = items.coalesce(1) if last_level else items.repartitionByRange("path")
        if levels and not last_level:
            # Several whole blocks a partition (one partition holds any few of them): every level is shorter.
            ordered = items.repartitionByRange(max(1, n // (8 * block)), "path")
        merge = _merger(last_level, bool(levels), block)
        made = ordered.sortWithinPartitions("path").mapInArrow(merge, f"{NODE_FIELDS}, {ITEM_FIELDS}")
        made = written(made, f"trie-level-{len(levels)}")
        levels.append(made.filter("path is null"))
        items = made.filter("path is not null").select("path", "sizes", "loads")
        n = 0 if last_level else items.count()
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return _with_parents(nodes, levels[1:])


def _with_parents(nodes: DataFrame, later: list[DataFrame]) -> DataFrame:
    columns = ["conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    if not later:
        return nodes.select(*columns)
    known = later[0]
    for level in later[1:]:
        known = known.unionByName(level)
    known = known.select(F.col("key").alias("parent_key"), F.col("conv").alias("found"))
    waiting = nodes.filter("parent_key is not null").drop("parent")
    if known.count() <= BROADCAST_NODES:
        joined = waiting.join(F.broadcast(known), "parent_key")
    else:
        # A parent may have very many children: they meet one of several copies of it.
        salts = 32
        known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = waiting.withColumn("salt", F.pmod(F.xxhash64("conv", "depth"), F.lit(salts)).cast("int"))
        joined = salted.join(known, ["parent_key", "salt"])
    rest = nodes.filter("parent_key is null").select(*columns)
    return rest.unionByName(joined.withColumnRenamed("found", "parent").select(*columns))
