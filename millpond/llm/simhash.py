"""Operator 7: near-duplicates by SimHash, compared by counts of differing bits.

A fingerprint has a bit set if it is set in over half of the hashes of the
document's word shingles; a shingle counts as often as it occurs, or once
(``distinct``). Equal fingerprints become one node. Nodes that may
be within the radius meet in buckets: either keys of whole blocks of bits,
chosen so that no pair within the radius can be missed (``block_tables``), or
samples of bits, enough of them to find a pair at the radius with a stated
probability (``sampled_tables``). A bucket larger than a tile is cut into
tiles, and each pair of tiles is a task of its own.

Inside a task each pair of a bucket is compared once, word by word of 64 bits,
a block of pairs at a time, and a block is abandoned once all its distances
exceed the radius. Tasks give at most one link per node, to the first of its
group, never all pairs. Connected components come from rounds of star
contraction over staged links.

``deduplicated`` takes these components as candidates only: inside each of
them, pairs within the radius are linked if the Jaccard similarity of their
sets of shingles, computed exactly, is high enough.

Defined cases: fewer words than a shingle make one shingle; no words make the
fingerprint zero, linked like any other; NULL texts count as empty; repeated
rows and equal texts share a node; a NULL identifier is never the smallest of
its component unless all are NULL; an empty table gives an empty result;
further columns travel in ``doc``, which holds all but the text.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work, byte_words

#: Nodes of a tile; a task compares two tiles at most.
TILE = 2048
#: Nodes of a bucket that more nodes do not exceed on average: more of them mean fewer tables.
BUCKET = 1024
#: Shingles of a tile in which sets are compared.
SET_TILE = 1 << 20
#: Pairs of fingerprints that are compared at once, so that their words stay in the cache.
CELLS = 1 << 14


# fingerprints


def shingle_hashes(text: str, words: int):
    """XXH64 (seed 42) of the shingles of a text, in arrays; A-Z count as a-z."""
    carry: list[bytes] = []
    any_shingle = False
    for some in byte_words(text.encode().lower()):
        some = carry + some
        n = len(some) - words + 1
        if n > 0:
            any_shingle = True
            grams = map(b" ".join, zip(*(some[i:] for i in range(words))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(42)), np.uint64, n)
            some = some[n:]
        carry = some
    if carry and not any_shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), 42)], np.uint64)


def _lanes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """(hashes, lanes): the hashes themselves, and for further lanes mixes of them."""
    steps = np.array([(0x9E3779B97F4A7C15 * lane) & 0xFFFFFFFFFFFFFFFF for lane in range(1, lanes)], np.uint64)
    x = hashes[:, None] + steps
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.concatenate([hashes[:, None], x ^ (x >> np.uint64(31))], axis=1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text or "", words)]))


def fingerprint(text: str | None, words: int, lanes: int) -> bytes:
    """8 bytes per lane, the highest bit first."""
    return _majority(shingle_hashes(text or "", words), lanes)


def _majority(parts, lanes: int) -> bytes:
    total, counts = 0, np.zeros(64 * lanes, np.int64)
    for hashes in parts:
        total += len(hashes)
        for start in range(0, len(hashes), 255):  # a count fits into a byte
            octets = _lanes(hashes[start : start + 255], lanes).astype(">u8").view(np.uint8)
            counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > total).tobytes()


# buckets


def block_tables(bits: int, radius: int, kept: int = 2) -> list[tuple[int, ...]]:
    """Bit positions of the keys: all choices of ``kept`` out of ``radius + kept`` blocks.

    Two fingerprints within the radius differ in at most ``radius`` blocks, so
    at least one choice of ``kept`` blocks is equal in both.
    """
    blocks = np.array_split(np.arange(bits), radius + kept)
    return [tuple(int(b) for block in chosen for b in block) for chosen in itertools.combinations(blocks, kept)]


def sampled_tables(bits: int, nodes: int, agreement: float, found: float = 0.97, seed: int = 7) -> list[tuple[int, ...]]:
    """Random bit positions: keys longer the more nodes there are, and enough tables.

    A pair of which each bit agrees with probability ``agreement`` is found with
    probability ``found`` at least; more alike pairs with more.
    """
    length = max(12, math.ceil(math.log2(max(nodes, 2) / BUCKET)))
    tables = math.ceil(math.log(1 - found) / math.log(1 - agreement**length))
    rng = np.random.default_rng(seed)
    return [tuple(int(b) for b in rng.choice(bits, length, replace=False)) for _ in range(tables)]


def _keys(prints: list[bytes], tables: list[tuple[int, ...]]) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), axis=1)
    return np.stack([bits[:, t] @ (np.int64(1) << np.arange(len(t), dtype=np.int64)) for t in tables], axis=1)


# comparison


def _columns(prints: np.ndarray) -> np.ndarray:
    """(words, nodes) of uint64 from (nodes, bytes): word after word, each of all nodes."""
    short = -prints.shape[1] % 8
    padded = np.pad(prints, ((0, 0), (0, short))) if short else np.ascontiguousarray(prints)
    return np.ascontiguousarray(padded.view(np.uint64).T)


def within(columns: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """(queries, nodes): which nodes are within the radius of which query, given the columns of both."""
    apart = np.zeros((queries.shape[1], columns.shape[1]), np.uint16)
    for word, (own, other) in enumerate(zip(queries, columns), 1):
        apart += np.bitwise_count(own[:, None] ^ other)
        # half of the bits of unrelated ones differ
        if word < len(columns) and 32 * word > radius and apart.size and apart.min() > radius:
            return np.zeros(apart.shape, bool)
    return apart <= radius


def linked(prints: np.ndarray, radius: int, dense: int = 512) -> np.ndarray:
    """For each fingerprint (rows of bytes) the first one of its group of links.

    A dense group is peeled off first: as all of its members are compared with
    what is left, the rest can be compared without it.
    """
    columns = _columns(prints)
    group = np.arange(len(prints))
    left = np.arange(len(prints))
    while len(left) > dense:
        own = columns[:, left]
        near = np.flatnonzero(within(own, own[:, :1], radius))
        if len(near) < len(left) // 8:
            break
        member = np.zeros(len(left), bool)
        member[near] = True
        queue = near
        while len(queue) and not member.all():
            rest = np.flatnonzero(~member)
            block = max(1, CELLS // len(rest))
            new = rest[within(own[:, rest], own[:, queue[:block]], radius).any(axis=0)]
            member[new] = True
            queue = np.concatenate([queue[block:], new])
        group[left[member]] = left[member].min()
        left = left[~member]
    own, pairs, start = columns[:, left], [], 0
    while start < len(left) - 1:  # each pair once: a query meets those behind it
        block = max(1, CELLS // (len(left) - start))
        at, node = np.nonzero(np.triu(within(own[:, start + 1 :], own[:, start : start + block], radius)))
        if len(at):
            pairs.append((start + at, start + 1 + node))
        start += block
    if pairs:
        a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        label = np.arange(len(left))
        while True:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = new[new]
            if (new == label).all():
                break
            label = new
        group[left] = left[label]
    return group


def _bucket_links(batches, radius: int, gathered: int = 128):
    """Links (a, b) of nodes from rows of buckets; small buckets are compared together."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch["nodes"]).to_numpy(zero_copy_only=False))
        nodes, prints = batch["nodes"].flatten().to_numpy(), _print_bytes(batch["prints"].flatten())
        first, begin = np.arange(len(nodes)), 0
        for end in ends:
            if end - begin >= gathered or end == len(nodes):
                first[begin:end] = begin + linked(prints[begin:end], radius)
                begin = end
        a, b = nodes, nodes[first]
        a, b = a[a != b], b[a != b]
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def _print_bytes(prints: pa.Array) -> np.ndarray:
    """(nodes, bytes) of fingerprints of one length."""
    width = len(prints[0].as_py()) if len(prints) else 8
    fixed = prints.cast(pa.binary(width))
    held = np.frombuffer(fixed.buffers()[1] or b"", np.uint8)
    return held[fixed.offset * width : (fixed.offset + len(fixed)) * width].reshape(len(fixed), width)


def links(work: Work, nodes: DataFrame, tables: list[tuple[int, ...]], radius: int, tile: int = TILE) -> DataFrame:
    """Links (a > b) that connect all ``nodes`` (node, print) within the radius that meet in a table."""

    @arrow_udf("array<long>")
    def keys_of(prints: pa.Array) -> pa.Array:
        found = _keys(prints.to_pylist(), tables)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, len(tables)), pa.int32()), pa.array(found.ravel()))

    keyed = nodes.select("node", "print", F.posexplode(keys_of("print")).alias("table", "key"))
    crowded = work.staged(
        keyed.groupBy("table", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > tile)
        .select(F.col("table").alias("in_table"), F.col("key").alias("in_key"), F.ceil(F.col("rows") / tile).cast("int").alias("tiles")),
        "crowded",
    )
    tiled = keyed.join(crowded, (F.col("table") == F.col("in_table")) & (F.col("key") == F.col("in_key")), "left").select(
        "node", "print", "table", "key", F.coalesce("tiles", F.lit(1)).alias("tiles"),
    )
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    # a node goes to the pairs of its own tile with each other one
    paired = tiled.select("node", "print", "table", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    buckets = (
        paired.groupBy("table", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.collect_list(F.struct("node", "print")).alias("members"))
        .where(F.size("members") > 1)
        .select(F.col("members.node").alias("nodes"), F.col("members.print").alias("prints"))
    )
    found = buckets.mapInArrow(lambda batches: _bucket_links(batches, radius), "a long, b long")
    return work.staged(found.distinct(), "near", rows_per_batch=64)  # a row is a bucket


def components(work: Work, edges: DataFrame) -> DataFrame:
    """``node`` and the smallest ``root`` connected with it, for nodes with links (a > b).

    Large-star and small-star rounds: each round links the neighbours of a node
    to the smallest of them. The work falls on joins and partial minima, so a
    node with very many links is no single task.
    """
    edges = work.staged(edges, "links")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m")).withColumn("m", F.least("of", "m"))
        large = both.join(least, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = work.staged(large.distinct(), "large-star")
        least = large.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
        ends = F.array("a", "b")
        small = large.join(least, F.col("a") == F.col("of")).select(F.explode(ends).alias("a"), F.col("m").alias("b"))
        new = work.staged(small.where("a > b").distinct(), "small-star")
        work.drop(edges, large)
        edges = new
        state = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def _named(
    docs: DataFrame, words: int, lanes: int, radius: int, agreement: float | None, doc_id: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """The rows (``row``, ``doc``, ``id``, ``print``) and the component of each fingerprint (``of_print``)."""

    @arrow_udf("binary")
    def print_of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words, lanes) for t in texts.to_pylist()], pa.binary())

    work = Work(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    found = docs.select(F.struct(*kept).alias("doc"), F.col(doc_id).alias("id"), print_of(F.col(text)).alias("print"))
    found = work.staged(found.withColumn("row", F.monotonically_increasing_id()), "prints")
    nodes = work.staged(
        found.groupBy("print").agg(F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    bits = 64 * lanes
    tables = block_tables(bits, radius) if agreement is None else sampled_tables(bits, nodes.count(), agreement)
    roots = components(work, links(work, nodes.select("node", "print"), tables, radius))
    rooted = work.staged(
        nodes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
            F.col("print").alias("of_print"), "least", F.coalesce("root", "node").alias("root")
        ),
        "rooted",
    )
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    return found, rooted.join(smallest, F.col("root") == F.col("of")).select("of_print", "component_id", "root")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    lanes: int = 8,
    radius: int = 86,
    agreement: float | None = 0.85,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc`` (all columns but the text), ``fingerprint`` (binary) and ``component_id`` of every row.

    The component is named by its smallest identifier. With an ``agreement``
    the buckets come from sampled bits, which find a pair that agrees in that
    share of the bits with probability 0.97; with None they are exact. The
    fingerprints alone decide, and a shingle weighs as often as it occurs.
    """
    found, named = _named(docs, words, lanes, radius, agreement, doc_id, text)
    return found.join(named, F.col("print") == F.col("of_print"), "inner").select(
        "doc", F.col("print").alias("fingerprint"), "component_id"
    )


# exact similarity


def alike(prints: np.ndarray, sets: list[np.ndarray], radius: int, jaccard: float) -> np.ndarray:
    """For each node the first one it is connected with by pairs within the radius and of that Jaccard similarity.

    A connected group is collected from its first node; only nodes that have no
    group yet are compared with its members.
    """
    wide = np.ascontiguousarray(prints).view(np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    group, left = np.arange(len(sets)), np.arange(len(sets))
    while len(left):
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(wide[left] ^ wide[at]).sum(axis=1) <= radius
            # sets of too different a size cannot be alike
            near &= np.minimum(sizes[left], sizes[at]) >= jaccard * np.maximum(sizes[left], sizes[at]) - 1e-9
            near &= sizes[left] > 0
            some = left[near]
            if not len(some):
                continue
            hashes = np.concatenate([sets[n] for n in some])
            place = np.minimum(np.searchsorted(sets[at], hashes), sizes[at] - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            shared = np.add.reduceat((sets[at][place] == hashes).astype(np.int64), starts)
            same = some[shared >= jaccard * (sizes[some] + sizes[at] - shared) - 1e-9]
            group[same] = first
            queue += list(same)
            left = np.setdiff1d(left, same, assume_unique=True)
    return group


def _alike_links(batches, words: int, radius: int, jaccard: float):
    """Links (a, b) inside each group of rows (root, low, high, node, print, text) that follow each other."""

    def links(nodes: list[int], prints: list[bytes], sets: list[np.ndarray]):
        first = alike(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), sets, radius, jaccard)
        ids = np.array(nodes, np.int64)
        a, b = ids, ids[first]
        a, b = a[a != b], b[a != b]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    of, nodes, prints, sets = None, [], [], []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("root", "low", "high", "node", "print", "text")]
        for *key, node, fp, text in zip(*columns):
            if key != of:
                if len(nodes) > 1:
                    yield links(nodes, prints, sets)
                of, nodes, prints, sets = key, [], [], []
            nodes.append(node)
            prints.append(fp)
            sets.append(shingle_set(text, words))
    if len(nodes) > 1:
        yield links(nodes, prints, sets)


def confirmed_links(
    work: Work, members: DataFrame, words: int, radius: int, jaccard: float, tile: int = SET_TILE, most: int = TILE
) -> DataFrame:
    """Links (a > b) that connect the ``members`` (root, node, print, n_shingles, text) of each root that are alike.

    A candidate component with more shingles or nodes than a tile is cut, and
    each pair of its tiles is compared on its own, so that every pair meets.
    """
    tiles = F.greatest(F.ceil(F.sum("n_shingles") / tile), F.ceil(F.count("*") / most)).cast("int")
    cut = members.groupBy(F.col("root").alias("in_root")).agg(tiles.alias("tiles"))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    tiled = members.join(cut, F.col("root") == F.col("in_root")).select(
        "root", "node", "print", "text", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    )
    group = ["root", "low", "high"]
    paired = tiled.select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "print", "text")
    dealt = paired.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(lambda batches: _alike_links(batches, words, radius, jaccard), "a long, b long").distinct()


def deduplicated(
    docs: DataFrame,
    words: int = 5,
    lanes: int = 8,
    radius: int = 120,
    agreement: float = 0.8,
    jaccard: float = 0.8,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row of each group of near-duplicates, that of its smallest identifier (NULL is the largest).

    Groups are connected by pairs whose sets of shingles have the Jaccard
    similarity or more, computed exactly. Fingerprints of the sets only name the
    candidates: pairs within the radius that meet in a table of sampled bits.
    Sets of Jaccard 0.8 differ in 512 * acos(0.89) / pi = 78 bits on average,
    with a deviation of 8; sets of four and five shingles in 96. An isolated
    pair at 0.8 is found with probability 0.998 (radius and tables, binomial
    model), that of four and five shingles with 0.98.
    """

    @arrow_udf("struct<print:binary,same:binary,n_shingles:long>")
    def set_of(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            own = shingle_set(t, words)
            rows.append({"print": _majority([own], lanes), "same": xxhash.xxh3_128_digest(own.tobytes()), "n_shingles": len(own)})
        kind = pa.struct([("print", pa.binary()), ("same", pa.binary()), ("n_shingles", pa.int64())])
        return pa.array(rows, kind)

    work = Work(docs.sparkSession)
    found = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("id"), F.col(text).alias("text"), set_of(F.col(text)).alias("set"))
    found = work.staged(found.select("doc", "id", "set.*").withColumn("row", F.monotonically_increasing_id()), "prints")
    # equal sets are one node
    nodes = work.staged(
        found.groupBy("print", "same", "n_shingles")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    tables = sampled_tables(64 * lanes, nodes.count(), agreement)
    roots = work.staged(components(work, links(work, nodes.select("node", "print"), tables, radius)), "candidates")
    grouped = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    members = grouped.select(F.col("node").alias("of"), "root").join(nodes, F.col("of") == F.col("node"))
    members = members.select("root", "node", "print", "n_shingles", F.col("first.row").alias("of_row"))
    texts = found.select("row", F.col(f"doc.`{text}`").alias("text"))
    members = texts.join(members, F.col("row") == F.col("of_row")).select("root", "node", "print", "n_shingles", "text")
    roots = components(work, confirmed_links(work, members, words, radius, jaccard))
    rooted = nodes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    first = rooted.groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
    stays = first.select(F.col("first.row").alias("of_row"))
    return found.join(stays, F.col("row") == F.col("of_row"), "left_semi").select("doc.*")
