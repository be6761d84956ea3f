"""Differences between two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators.snapshot import SnapshotTable


def _paired(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key with both sides as structs, NULL where a side lacks the key.

    One grouping over both sides, combined before the shuffle; a key held
    twice on one side is an error rather than a product of pairs.
    """
    sides = old.select(key, F.lit(0).alias("_side"), F.struct(*columns).alias("_row")).unionByName(
        new.select(key, F.lit(1).alias("_side"), F.struct(*columns).alias("_row"))
    )

    def of(side):
        return F.col("_side") == side

    grouped = sides.groupBy(key).agg(
        F.max(F.when(of(0), F.col("_row"))).alias("old"),
        F.max(F.when(of(1), F.col("_row"))).alias("new"),
        F.greatest(F.count_if(of(0)), F.count_if(of(1))).alias("_most"),
    )
    repeated = F.raise_error(F.lit(f"{key} is not unique")).cast("boolean")
    return grouped.where(F.when(F.col("_most") > 1, repeated).otherwise(F.lit(True))).drop("_most")


def changed_values(current: DataFrame, previous: DataFrame, key: str, value: str) -> DataFrame:
    """Keys in both whose value differs (``!=``, so a change from or to NULL does not count)."""
    return (
        _paired(previous, current, key, [value])
        .where(F.col(f"new.{value}") != F.col(f"old.{value}"))
        .select(key, F.col(f"new.{value}").alias(f"current_{value}"), F.col(f"old.{value}").alias(f"previous_{value}"))
    )


def row_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Added, removed and changed keys between ``left`` (old) and ``right`` (new), NULL-safe."""
    columns = [c for c in right.columns if c != key and c in left.columns]
    kind = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return (
        _paired(left, right, key, columns)
        .select(
            key, kind.alias("diff"),
            *[F.col(f"old.{c}").alias(f"old_{c}") for c in columns],
            *[F.col(f"new.{c}").alias(f"new_{c}") for c in columns],
        )
        .where("diff IS NOT NULL")
    )


def version_diff(table: SnapshotTable, previous: int, current: int, key: str, value: str) -> DataFrame:
    """Changed values between two versions, reading only files they do not share.

    The key must be unique within a version.
    """
    old, new = table.differing_rows(previous, current)
    return changed_values(new, old, key, value)


def version_diff_full(table: SnapshotTable, previous: int, current: int, key: str) -> DataFrame:
    """All row differences between two versions, reading only files they do not share."""
    old, new = table.differing_rows(previous, current)
    return row_diff(old, new, key)
