"""Operator 13: the trie of all beginnings of conversations, from ternary search trees per range shard.

1. Distinct turns (role and text) make a dictionary in the order of role and
   text; from there on a conversation is its identifier with an array of turn
   ids and of text sizes.
2. Sequences are dealt out by ranges of (turn ids, identifier), so equal ones,
   however many, spread over shards in the order of their identifiers.
3. Each shard builds a ternary search tree of its distinct sequences, medians
   first, and sums members, leaves and savings in one pass from the last made
   node to the first, without recursion.
4. Only nodes on the path of a shard's first or last sequence can occur in
   another shard. One small task merges these (at most two paths per shard),
   adds what lies between them, and gives the others their parents. All other
   nodes are final in their shard.

A node's ends, the identifiers of the conversations that stop there, are kept
in pieces of at most ``PIECE``, in order.

Defined cases: NULL roles and texts are empty; a NULL turn comes first; equal
turn numbers stand in the order of role and text; repeated rows are turns of
their own; rows without an identifier belong to no conversation; no
conversations make no nodes; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm.common import Work

#: Turns of a shard, about, and identifiers of a piece.
SHARD, PIECE = 200_000, 4096
#: Node ids of shard s start at (s + 1) * 2**36; merged nodes count from 0.
_SHIFT = 36
#: The parent of the root.
_NONE = -1

_NUMBERS = ["id", "parent", "depth", "turn", "size", "n_convs", "conv", "parent_conv", "n_children", "n_leaves", "saved"]
_GROWN = pa.schema(
    [("kind", pa.string()), *[(c, pa.int64()) for c in _NUMBERS], ("piece", pa.int64()), ("ends", pa.list_(pa.int64()))]
)
_GROWN_DDL = f"kind string, {', '.join(f'{c} long' for c in _NUMBERS)}, piece long, ends array<long>"
_MERGED = pa.schema([("local", pa.int64()), ("first", pa.bool_()), *[(c, pa.int64()) for c in _NUMBERS]])
_MERGED_DDL = f"local long, first boolean, {', '.join(f'{c} long' for c in _NUMBERS)}"


@dataclass
class Trie:
    """``nodes`` (id, parent, depth, turn, n_convs, conv, parent_conv, n_children, n_leaves, saved), and ``ends``
    (node, at, piece, ends): the identifiers that stop at a node, in the order of (at, piece)."""

    nodes: DataFrame
    ends: DataFrame


def encoded(
    work: Work, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Conversations as (conv, ids, sizes), and the dictionary (turn_id, role, text, digest) of their turns."""
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    spelled = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.unhex(F.sha2(spelled, 256))
    distinct = work.staged(rows.select("role", "text").distinct(), "turns")
    dictionary = work.staged(
        distinct.repartitionByRange("role", "text")
        .sortWithinPartitions("role", "text")
        .select(F.monotonically_increasing_id().alias("turn_id"), "role", "text", digest.alias("digest")),
        "dictionary",
    )
    ids = dictionary.select("turn_id", F.col("digest").alias("of"))
    turns = rows.select("conv", "turn", F.octet_length("text").alias("size"), digest.alias("digest"))
    in_order = F.sort_array(F.collect_list(F.struct("turn", "turn_id", "size")))
    own = (
        turns.join(ids, F.col("digest") == F.col("of"), "inner")
        .groupBy("conv")
        .agg(in_order.alias("turns"))
        .select("conv", F.col("turns.turn_id").alias("ids"), F.col("turns.size").cast("array<long>").alias("sizes"))
    )
    return work.staged(own, "encoded"), dictionary


class SearchTree:
    """A ternary search tree over turn ids; each of its nodes is a node of the trie, 0 the root."""

    def __init__(self):
        self.turn, self.size, self.parent, self.depth = [0], [0], [-1], [0]
        self.low, self.high, self.equal = [-1], [-1], [-1]

    def _grown(self, turn: int, size: int, parent: int) -> int:
        self.turn.append(turn)
        self.size.append(size)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.high, self.equal):
            links.append(-1)
        return len(self.turn) - 1

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node of a sequence, with the nodes before it."""
        at = 0
        for turn, size in zip(ids, sizes):
            links, slot = self.equal, at
            while (node := links[slot]) >= 0 and self.turn[node] != turn:
                links, slot = (self.low if turn < self.turn[node] else self.high), node
            if node < 0:
                node = links[slot] = self._grown(turn, size, at)
            at = node
        return at

    def path(self, node: int) -> Iterator[int]:
        while node >= 0:
            yield node
            node = self.parent[node]


def medians_first(count: int) -> Iterator[int]:
    """0 to count - 1, so that a search tree grown in this order from sorted keys is balanced."""
    spans = [(0, count)]
    while spans:
        low, high = spans.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(middle + 1, high), (low, middle)]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard: final ones, those on its first and last path, and pieces of ends."""
    shard, sequences, members = 0, [], []
    for batch in batches:
        for row in batch.to_pylist():
            shard = row["shard"]
            if not sequences or sequences[-1][0] != row["ids"]:
                sequences.append((row["ids"], row["sizes"]))
                members.append([])
            members[-1].append(row["conv"])
    if not sequences:
        return
    tree, ends = SearchTree(), {}
    for i in medians_first(len(sequences)):
        ends[tree.insert(*sequences[i])] = members[i]
    count = len(tree.turn)
    shared = [False] * count
    for ids, sizes in (sequences[0], sequences[-1]):
        for node in tree.path(tree.insert(ids, sizes)):
            shared[node] = True
    n_convs = [len(ends.get(i, ())) for i in range(count)]
    conv = [min(ends[i]) if i in ends else None for i in range(count)]
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for i in range(count - 1, 0, -1):  # a node is made after its parent
        p = tree.parent[i]
        n_convs[p] += n_convs[i]
        conv[p] = conv[i] if conv[p] is None else min(conv[p], conv[i])
        if not shared[i]:
            leaves[i] += not children[i]
            saved[i] += (n_convs[i] - 1) * tree.size[i]
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    base = (shard + 1) << _SHIFT
    for start in range(0, count, PIECE):
        own = range(start, min(start + PIECE, count))
        parents = [tree.parent[i] for i in own]
        columns = {
            "kind": ["path" if shared[i] else "node" for i in own],
            "id": [base + i for i in own],
            "parent": [base + p if p >= 0 else _NONE for p in parents],
            "depth": tree.depth[start : own.stop], "turn": tree.turn[start : own.stop], "size": tree.size[start : own.stop],
            "n_convs": n_convs[start : own.stop], "conv": conv[start : own.stop],
            "parent_conv": [conv[p] if p >= 0 and not shared[p] else None for p in parents],
            "n_children": children[start : own.stop], "n_leaves": leaves[start : own.stop], "saved": saved[start : own.stop],
            "piece": [None] * len(own), "ends": [None] * len(own),
        }
        yield pa.RecordBatch.from_pydict(columns, schema=_GROWN)
    rows = []
    for node, convs in ends.items():
        for at in range(0, len(convs), PIECE):
            rows.append({"kind": "ends", "id": base + node, "piece": at, "ends": convs[at : at + PIECE]})
            if len(rows) == 256:
                yield pa.RecordBatch.from_pylist(rows, schema=_GROWN)
                rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_GROWN)


def _merged(paths: pa.Table) -> pa.Table:
    """Nodes of the shards' first and last paths, equal ones merged; one row for each node of a shard."""
    merged: dict[tuple[int, int], int] = {}
    number: dict[int, int] = {}
    nodes: list[dict] = []
    for row in paths.sort_by([("depth", "ascending"), ("id", "ascending")]).to_pylist():
        parent = number[row["parent"]] if row["depth"] else _NONE
        at = merged.setdefault((parent, row["turn"]), len(nodes))
        number[row["id"]] = at
        if at == len(nodes):
            nodes.append(row | {"id": at, "parent": parent, "local": row["id"]})
            continue
        node = nodes[at]
        node["conv"] = min(node["conv"], row["conv"])
        for part in ("n_convs", "n_children", "n_leaves", "saved"):
            node[part] += row[part]
    for node in reversed(nodes):  # parents come before their children
        node["n_leaves"] += not node["n_children"]
        node["saved"] += (node["n_convs"] - 1) * node["size"]
        if node["depth"]:
            above = nodes[node["parent"]]
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved"] += node["saved"]
            node["parent_conv"] = above["conv"]
    rows = [nodes[at] | {"local": local, "first": nodes[at]["local"] == local} for local, at in number.items()]
    return pa.Table.from_pylist(rows, schema=_MERGED)


def trie(work: Work, sequences: DataFrame, shards: int | None = None) -> Trie:
    """The trie of staged sequences (conv, ids, sizes); ``conv`` must be unique."""
    if shards is None:
        turns = sequences.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
        shards = turns // SHARD + 1
    grown = (
        sequences.repartitionByRange(shards, "ids", "conv")
        .sortWithinPartitions("ids", "conv")
        .select("conv", "ids", "sizes", F.spark_partition_id().alias("shard"))
        .mapInArrow(_shard, _GROWN_DDL)
    )
    grown = work.staged(grown, "shards")
    paths = grown.where("kind = 'path'").select("kind", *_NUMBERS)
    merged = work.staged(paths.groupBy("kind").applyInArrow(_merged, _MERGED_DDL), "merged-paths")
    known = merged.select("local", F.col("id").alias("merged"), F.col("conv").alias("merged_conv"))
    shown = ["id", "parent", "depth", "turn", "n_convs", "conv", "parent_conv", "n_children", "n_leaves", "saved"]
    inner = (
        grown.where("kind = 'node'")
        .join(known, F.col("parent") == F.col("local"), "left")
        .withColumn("parent", F.coalesce("merged", "parent"))
        .withColumn("parent_conv", F.coalesce("merged_conv", "parent_conv"))
    )
    ends = grown.where("kind = 'ends'").join(known, F.col("id") == F.col("local"), "left")
    return Trie(
        inner.select(*shown).unionByName(merged.where("first").select(*shown)).withColumn("parent", F.expr("nullif(parent, -1)")),
        ends.select(F.coalesce("merged", "id").alias("node"), F.col("id").alias("at"), "piece", "ends"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the identifiers of each node, which come sorted, one piece at a time."""
    schema = pa.schema([("node", pa.int64()), ("ends_sha256", pa.string())])
    current, running = None, None
    for batch in batches:
        done = []
        for node, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != current:
                if running is not None:
                    done.append((current, running.hexdigest()))
                current, running = node, hashlib.sha256()
            else:
                running.update(b",")
            running.update(",".join(map(str, ends)).encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], schema=schema)
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([running.hexdigest()])], schema=schema)


def ends_digests(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of its identifiers in decimal, joined by commas.

    A digest needs its identifiers in a row: one task reads those of a node, a
    piece at a time.
    """
    in_order = ends.repartition("node").sortWithinPartitions("node", "at", "piece").select("node", "ends")
    return in_order.mapInArrow(_digests, "node long, ends_sha256 string")
