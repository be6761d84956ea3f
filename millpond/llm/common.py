"""What the operators share: staged tables, words, and global ranks."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millpond.workspace import new_path

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch that goes to a Python worker.
ROWS_PER_BATCH = 500

_ROOT = str(Path(__file__).resolve().parents[2])
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Work:
    """Tables of one run in the shared folder.

    ``staged`` cuts the lineage: what follows reads complete files, so that a
    lost executor costs a task and not the run, and the shuffle files of the
    written job go at once. ``drop`` deletes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.tables: list[DataFrame] = []
        # workers import this package from where the driver found it, unless it is installed or shipped
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if _ROOT not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [_ROOT])
        # texts are large rows: ten thousand of them (the default) are too much for one Arrow batch
        if int(spark.conf.get(_BATCH)) > ROWS_PER_BATCH:
            spark.conf.set(_BATCH, ROWS_PER_BATCH)

    def staged(self, df: DataFrame, label: str, rows_per_batch: int = ROWS_PER_BATCH) -> DataFrame:
        path = new_path(self.spark, label)
        before = self.spark.conf.get(_CLEANUP, "false")
        batch = self.spark.conf.get(_BATCH)
        self.spark.conf.set(_CLEANUP, "true")
        self.spark.conf.set(_BATCH, min(int(batch), rows_per_batch))
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
            self.spark.conf.set(_BATCH, batch)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        self.tables.append(table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, **named: str) -> DataFrame:
    """All columns as the struct ``doc``, beside copies of those an operator reads.

    Operators work on names of their own, so that no column of the input can
    clash with them; ``select("doc.*")`` gives the input back.
    """
    return docs.select(F.struct("*").alias("doc"), *[F.col(column).alias(name) for name, column in named.items()])


def word_count(text) -> F.Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_words(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists from about ``size`` bytes each.

    ``bytes.split`` splits at exactly the six white-space bytes of ``WORD``.
    """
    if len(data) <= size:
        yield data.split()
        return
    start, tail = 0, b""
    while start < len(data):
        piece = tail + data[start : start + size]
        start += size
        words = piece.split()
        tail = b""
        if start < len(data) and words and piece[-1:] not in b" \t\n\x0b\x0c\r":
            tail = words.pop()
        yield words
    if tail:
        yield [tail]


def global_rank(work: Work, df: DataFrame, within: list[str], order: list[str], name: str) -> tuple[DataFrame, list]:
    """``df`` with the position of each row, from 0, in ``order`` among the rows equal in ``within``.

    Rows are dealt out by ranges of all the named columns, so that one huge
    group spreads over many tasks; the rank is the position in the own range
    plus the rows of the same group in the ranges before. Only the counts per
    (range, group) are summed over a window, never the rows. Returns the frame
    and the staged tables it reads, to be dropped after use.
    """
    keys = [*within, *order]
    placed = work.staged(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    placed_part = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed_part.groupBy("_part", *within)
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    parts = work.staged(parts.select("_part", "_first", "_before", *[F.col(c).alias(f"_in_{c}") for c in within]), f"{name}-parts")
    same = F.col("_part") == F.col("_of")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"_in_{c}"))
    ranked = placed_part.join(parts.withColumnRenamed("_part", "_of"), same, "inner").withColumn(
        name, F.col("_at") - F.col("_first") + F.col("_before")
    )
    return ranked.drop("_at", "_part", "_of", "_first", "_before", *[f"_in_{c}" for c in within]), [placed, parts]
