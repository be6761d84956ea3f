"""Slowly changing dimensions, type 2: history kept as ``[valid_from, valid_to)`` rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.operators.merge import WhenMatched, WhenNotMatched, absent_rows
from millpond.operators.snapshot import SnapshotTable
from millpond.workspace import staged


def open_history(df: DataFrame, valid_from: str) -> DataFrame:
    """First load: every row current since ``valid_from`` (an ISO date)."""
    return df.select(
        "*",
        F.lit(valid_from).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def _differs(tracked: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(f"d.{c}").eqNullSafe(F.col(f"u.{c}")) for c in tracked])


def scd2_apply(dim: DataFrame, updates: DataFrame, key: str, tracked: list[str], effective: str) -> DataFrame:
    """The whole dimension after ``updates`` (one row per key) take effect on a date.

    A key whose tracked columns differ is expired and gets a new current row;
    a new key gets its first row. Only current rows join. The updates are
    written once, so that the planner knows whether they can be broadcast.
    """
    updates = staged(updates, "scd-updates")
    since = F.lit(effective).cast("date")
    is_current = F.coalesce(F.col("is_current"), F.lit(False))
    current, past = dim.where(is_current), dim.where(~is_current)
    marked = updates.withColumn("_present", F.lit(True))
    pairs = current.alias("d").join(marked.alias("u"), F.col(f"d.{key}") == F.col(f"u.{key}"), "left")

    def row(**values: Column) -> Column:
        return F.struct(*[values.get(c, F.col(f"d.{c}")).alias(c) for c in dim.columns])

    expired = row(valid_to=since, is_current=F.lit(False))
    opened = row(
        valid_from=since, valid_to=F.lit(None).cast("date"), is_current=F.lit(True),
        **{c: F.col(f"u.{c}") for c in updates.columns if c in dim.columns and c != key},
    )
    changed = F.col("u._present").isNotNull() & _differs(tracked)
    moved = pairs.select(
        F.explode(F.when(changed, F.array(expired, opened)).otherwise(F.array(row()))).alias("r")
    ).select("r.*")
    arrived = open_history(absent_rows(updates, current, [key]), effective)
    return past.unionByName(moved).unionByName(arrived, allowMissingColumns=True)


def scd2_merge(
    table: SnapshotTable, updates: DataFrame, key: str, tracked: list[str], effective: str, at=None
) -> int:
    """The same change as one MERGE: only files with an expiring row are rewritten.

    Each changed row goes in twice, once to expire the current row and once
    without a key, so that it cannot match and is inserted.
    """
    updates = staged(updates, "scd-updates")
    # only rows of updated keys, found with the dimension on the left of the join
    known = table.read().where("is_current").select(key, *tracked).join(
        updates.select(key).distinct(), key, "left_semi"
    )
    pairs = updates.alias("u").join(
        known.withColumn("_known", F.lit(True)).alias("d"), F.col(f"u.{key}") == F.col(f"d.{key}"), "left"
    )
    news = pairs.where(F.col("d._known").isNull() | _differs(tracked)).select(
        "u.*", F.col("d._known").isNotNull().alias("_expires")
    )
    nothing = F.lit(None).cast(updates.schema[key].dataType)
    roles = F.when(F.col("_expires"), F.array(F.lit("expire"), F.lit("open"))).otherwise(F.array(F.lit("open")))
    source = (
        news.select("*", F.explode(roles).alias("_role"))
        .withColumn("_key", F.col(key))
        .withColumn(key, F.when(F.col("_role") == "expire", F.col(key)).otherwise(nothing))
    )
    since = F.lit(effective).cast("date")
    values = {c: F.col(f"s.{c}") for c in updates.columns if c != key}
    return table.merge(
        source, [key],
        matched=[WhenMatched("t.is_current", {"valid_to": since, "is_current": F.lit(False)})],
        not_matched=[WhenNotMatched("s._role = 'open'", {
            key: F.col("s._key"), **values,
            "valid_from": since, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True),
        })],
        at=at,
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")
