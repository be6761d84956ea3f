"""Rows that Spark makes up from a range of ids, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the vocabulary of the synthetic transactions
DEPARTMENTS = ["Engineering", "Marketing", "HR", "Finance", "Sales"]
REGIONS = ["North", "South", "East", "West"]
STATUSES = ["completed", "pending", "cancelled"]


def doubled(ids: DataFrame) -> DataFrame:
    """Ids, of a table or of a range, each with its double."""
    return ids.selectExpr("id", "id * 2 AS doubled")


def doubled_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Ids from ``start`` up to, not including, ``end``, each with its double."""
    return doubled(spark.range(start, end))


def _draw(key: Column, seed: int, stream: int, size: int) -> Column:
    """A number below ``size`` that depends only on key, seed and stream."""
    mixed = F.pmod(key, F.lit(1_000_003)) * (7_919 + 2 * stream) + seed * 104_729 + stream * 15_485_863
    return F.pmod(F.pmod(mixed, F.lit(1_000_003)) * 31, F.lit(size))


def _choice(key: Column, seed: int, stream: int, values: list[str]) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    # element_at takes the last of elements that are never NULL for a NULL position
    return F.when(key.isNotNull(), F.element_at(options, (_draw(key, seed, stream, len(values)) + 1).cast("int")))


def synthetic_transactions(ids: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One made-up transaction per id; ids may come from a table or a range."""
    k = F.col(key).cast("long")
    return ids.select(
        k.alias("txn_id"),
        F.concat(F.lit("EMP-"), _draw(k, seed, 1, 100) + 1).alias("emp_id"),
        _choice(k, seed, 2, DEPARTMENTS).alias("dept"),
        _choice(k, seed, 3, REGIONS).alias("region"),
        _choice(k, seed, 4, STATUSES).alias("status"),
        (_draw(k, seed, 5, 9_901) + 100).alias("amount"),
        (F.lit(0.5) + _draw(k, seed, 6, 4_501) / F.lit(1000)).alias("exchange_rate"),
    )
