"""Find a bad run by its differences, put the table back, prove the totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators.diff import version_diff_full
from millpond.operators.snapshot import SnapshotTable


def totals(rows: DataFrame, value: str) -> DataFrame:
    """Row count and total, summed in exact millionths so that the order of partitions does not matter."""
    exact = F.round(F.sum(F.col(value).cast("decimal(38,6)")), 2).cast("double")
    return rows.agg(F.count("*").alias("row_count"), exact.alias("total"))


def recover(table: SnapshotTable, good_version: int, key: str) -> int | None:
    """Restore ``good_version`` if any row was lost, added or changed since; returns the new version or None."""
    bad = version_diff_full(table, good_version, table.current_version(), key)
    if not bad.take(1):
        return None
    return table.restore(good_version)
