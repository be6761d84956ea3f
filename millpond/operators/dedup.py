"""One row per key by aggregation, so that copies combine before the shuffle.

A window would bring a whole group of copies into one task; a min/max over a
struct keeps one candidate per key and input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order_by: list[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = [c for c in order_by if c not in keys] + rest
    if not ranked:
        return df.distinct()
    best = choose(F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the smallest ``order_by`` per key; ties fall to the smallest remaining columns."""
    return _pick(df, keys, order_by, F.min)


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key; ties fall to the greatest remaining columns."""
    return _pick(df, keys, order_by, F.max)


def duplicate_keys(df: DataFrame, keys: list[str], count_name: str = "count") -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).where(F.col(count_name) > 1)
