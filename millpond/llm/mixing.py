"""Operator 1: mixing sources to target weights by systematic sampling.

DataFrame functions only. Within each source the expected copies of the
documents are summed up in order of size, one random offset per source is
added, and a document is emitted once per integer boundary that its share of
the sum crosses. All documents of a source expect the same number of copies
(target over size of the source), so the prefix sum at rank k is k times that
rate, in exact decimals. The order by size makes the taken words of a source
come near its target: the error is of the order of one document.

Defined cases: a NULL or empty text has size 0 and still its expected copies
(they take no words); a NULL source is a source of its own, ordered last;
repeated rows are ranked one by one; equal sizes are ordered by a hash of the
identifier; a source without any word has target 0 and emits nothing; an empty
table gives an empty result. Further columns travel along under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.llm.common import Work, global_rank, packed, word_count

#: Offset bits of the random start of each source.
_GRID = 1 << 20


def _targets(work: Work, sizes: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """One row per source: size, target. Excess over ``cap`` times the size is reshared by weight."""
    totals = work.staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ordered, _ = global_rank(work, totals.withColumn("last", F.col("source").isNull()), [], ["last", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = work.staged(
        ordered.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("most")),
        "weights",
    )
    level = 0.0
    while True:
        full = F.col("most") < F.col("weight") * F.lit(level)
        total, held, free, capped = sources.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)
        ).first()
        if not free or not total:
            break
        new_level = (total - (held or 0.0)) / free
        if new_level <= level:
            break
        level = new_level
    return sources.select(
        F.col("source").alias("of"),
        "source_size",
        F.least("most", F.col("weight") * F.lit(float(level))).alias("target"),
    )


def sampled(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: int = 20,
) -> DataFrame:
    """``doc`` (the input row), ``size``, ``source_size``, ``target`` and ``copies`` of every row.

    ``size`` is a column over ``docs`` (default: the words of ``text``).
    Reruns give the same copies: order, offset and rates follow from the rows.
    """
    work = Work(docs.sparkSession)
    # sizes are measured once; the range sort below reads its input twice
    rows = packed(docs.withColumn("_size", word_count("text") if size is None else size), source=source, id=doc_id, size="_size")
    rows = rows.withColumn("doc", F.col("doc").dropFields("_size"))
    measured = work.staged(rows, "measured")
    targets = work.staged(_targets(work, measured.select("source", "size"), weights, cap), "targets")
    tie = F.xxhash64(F.col("id"), F.lit(seed))
    ranked, _ = global_rank(work, measured.withColumn("tie", tie), ["source"], ["size", "tie", "id"], "rank")
    work.drop(measured)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.nullif("source_size", F.lit(0))).otherwise(0.0)
    rate = F.least(rate, F.lit(float(cap))).cast("decimal(17,16)")
    offset = (F.pmod(F.xxhash64(F.col("source"), F.lit(seed)), F.lit(_GRID)) / _GRID).cast("decimal(17,16)")

    def crossed(rank: Column) -> Column:
        return F.floor(rank.cast("decimal(15,0)") * F.col("rate") + F.col("offset"))

    copies = (crossed(F.col("rank") + 1) - crossed(F.col("rank"))).cast("long")
    return (
        ranked.join(targets, F.col("source").eqNullSafe(F.col("of")), "inner")
        .withColumns({"rate": rate, "offset": offset})
        .select("doc", "size", "source_size", "target", copies.alias("copies"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with the columns of ``docs``."""
    taken = sampled(docs, **options).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")
