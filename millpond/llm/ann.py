"""Operator 9: approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut in two halves, each quantised by its
own centroids (fitted on a bounded sample); a pair of centroids is a cell, and
every vector is indexed in its cell. A query goes through the cells in the
order of the summed distances of their halves, by a heap, until the cells hold
``share`` of all vectors or ``least`` of them, whichever is more; all entries
of these cells are reranked by their exact cosine on the original vectors.

The cells of one first centroid are worked off together. A crowded row of
cells is cut into tiles of entries and of queries; each pair of tiles is one
block product that gives only the nearest few of each query.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, nor do those of another than the most frequent
length; rows that repeat an identifier count as one candidate, of the larger
cosine, and as one query; ties go to the smaller identifier; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from millpond.llm.common import Work

#: Vectors the centroids are fitted on, entries of a tile, queries of a tile.
SAMPLE, ENTRIES, QUERIES = 20_000, 4096, 1024
#: Centroids of a half at most, hence at most their square of cells.
MOST_CENTROIDS = 512


def fitted(vectors: np.ndarray, count: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids by k-means, started from a random choice of different vectors."""
    different = np.unique(vectors, axis=0)
    rng = np.random.default_rng(seed)
    centres = different[rng.choice(len(different), min(count, len(different)), replace=False)]
    for _ in range(rounds):
        nearest = _distances(vectors, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(axis=1) - 2.0 * vectors @ centres.T


def _unit(rows: list) -> np.ndarray:
    vectors = np.array(rows, np.float64)
    # the largest component first: squares of huge or tiny numbers stay finite
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def traversed(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells by growing sum of their two distances, until they hold ``wanted`` entries; empty ones are left out."""
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[by_first], second[by_second]
    heap, found, held = [(a[0] + b[0], 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(by_first[i]) * len(second) + int(by_second[j])
        if sizes[cell]:
            found.append(cell)
            held += int(sizes[cell])
        # every pair is reached once: along its row from the first column, there from above
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return found


def nearest(queries: pd.DataFrame, entries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest entries of each query of a block among the cells it goes through."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if len(queries) and len(entries):
        ids, second = entries["id"].to_numpy(), entries["second"].to_numpy()
        vectors = np.array(entries["vector"].tolist(), np.float64)
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        repeats = len(ids) - len(np.unique(ids))
        rough = _unit(queries["q_vector"].tolist()) @ _unit(entries["vector"].tolist()).T
        for query, vector, seconds, scores in zip(queries["q_id"].to_numpy(), queries["q_vector"], queries["seconds"], rough):
            own = np.flatnonzero(np.isin(second, seconds) & (ids != query))
            if not len(own):
                continue
            scores = scores[own]
            # the block product rounds by position: keep what may tie, then sum row by row
            place = max(0, len(own) - k - repeats)
            bound = np.partition(scores, place)[place] - 1e-9
            own = own[scores >= bound]
            q = np.asarray(vector, np.float64)
            exact = (vectors[own] * q).sum(axis=1) / (np.sqrt((q * q).sum()) * lengths[own])
            best = np.lexsort((ids[own], -exact))
            if repeats:  # the best of the rows with one identifier
                best = best[np.sort(np.unique(ids[own[best]], return_index=True)[1])]
            best = best[:k]
            found.append((np.full(len(best), query), ids[own[best]], exact[best]))
    query_id, vec_id, score = (np.concatenate(column) for column in zip(*found))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part."""
    vector = F.col(embedding).cast("array<double>")
    found = vectors.select(F.col(vec_id).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = found.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    common = lengths.agg(F.max_by("n", F.struct("rows", "n"))).first()[0]
    return found.where(F.size("vector") == F.lit(common))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    share: float = 0.55,
    least: int = 2000,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found for each row with ``is_query`` (over ``id``)."""
    work = Work(vectors.sparkSession)
    rows = work.staged(usable(vectors, vec_id, embedding), "vectors")
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()["vector"].tolist()
    if not sample:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    unit = _unit(sample)
    half = unit.shape[1] // 2
    count = min(MOST_CENTROIDS, max(1, round(math.sqrt(total / 16))))
    first, second = fitted(unit[:, :half], count) if half else np.zeros((1, 0)), fitted(unit[:, half:], count)
    wanted = max(least, math.ceil(share * total))

    @arrow_udf("int")
    def cell_of(batch: pa.Array) -> pa.Array:
        unit = _unit(batch.to_pylist()) if len(batch) else np.empty((0, first.shape[1] + second.shape[1]))
        a, b = _distances(unit[:, :half], first).argmin(axis=1), _distances(unit[:, half:], second).argmin(axis=1)
        return pa.array((a * len(second) + b).astype(np.int32))

    indexed = work.staged(rows.select("id", "vector", cell_of("vector").alias("cell")), "cells")
    in_cell = indexed.groupBy("cell").agg(F.count("*").alias("entries"))
    sizes = np.zeros(len(first) * len(second), np.int64)  # bounded by the square of MOST_CENTROIDS
    for row in in_cell.toLocalIterator():
        sizes[row["cell"]] = row["entries"]

    @arrow_udf("array<struct<first:int,seconds:array<int>>>")
    def rows_of(batch: pa.Array) -> pa.Array:
        unit = _unit(batch.to_pylist()) if len(batch) else np.empty((0, first.shape[1] + second.shape[1]))
        a, b = _distances(unit[:, :half], first), _distances(unit[:, half:], second)
        out = []
        for x, y in zip(a, b):
            rows: dict[int, list[int]] = {}
            for cell in traversed(x, y, sizes, wanted):
                rows.setdefault(cell // len(second), []).append(cell % len(second))
            out.append([{"first": i, "seconds": js} for i, js in rows.items()])
        return pa.array(out, pa.list_(pa.struct([("first", pa.int32()), ("seconds", pa.list_(pa.int32()))])))

    queries = rows.where(is_query).groupBy("id").agg(F.min("vector").alias("vector"))
    probes = work.staged(
        queries.select(F.col("id").alias("q_id"), F.col("vector").alias("q_vector"), F.explode(rows_of("vector")).alias("row"))
        .select("q_id", "q_vector", F.col("row.first").alias("q_first"), "row.seconds"),
        "probes",
    )
    width = len(second)
    entries = indexed.select(F.floor(F.col("cell") / width).cast("int").alias("first"), (F.col("cell") % width).alias("second"), "id", "vector")
    tiles = work.staged(
        probes.groupBy("q_first").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("q_tiles"))
        .join(entries.groupBy("first").agg(F.ceil(F.count("*") / ENTRIES).cast("int").alias("e_tiles")), F.col("q_first") == F.col("first"))
        .select(F.col("first").alias("of"), "q_tiles", "e_tiles"),
        "tiles",
    )

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    entry_tiles = entries.join(tiles, F.col("first") == F.col("of")).select(
        "first", F.pmod(F.xxhash64("id"), F.col("e_tiles")).cast("int").alias("e"), every("q_tiles").alias("q"), "second", "id", "vector"
    )
    query_tiles = probes.join(tiles, F.col("q_first") == F.col("of")).select(
        "q_first", F.pmod(F.xxhash64("q_id"), F.col("q_tiles")).cast("int").alias("q_q"), every("e_tiles").alias("q_e"), "q_id", "q_vector", "seconds"
    )
    found = (
        query_tiles.groupBy("q_first", "q_e", "q_q")
        .cogroup(entry_tiles.groupBy("first", "e", "q"))
        .applyInPandas(lambda a, b: nearest(a, b, k), "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
