"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millpond.operators.layout import measured_bytes
from millpond.workspace import staged

BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if ``df`` is measured to be within ``max_bytes``.

    A larger side comes back without a hint and is shuffled.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def point_in_time_join(
    facts: DataFrame, history: DataFrame, key: str, on_date: Column | str,
    valid_from: str = "valid_from", valid_to: str = "valid_to",
) -> DataFrame:
    """Each fact with the history row of its key valid on its date, ``[valid_from, valid_to)``.

    An open ``valid_to`` has no end. The key stays an equality, so the join
    hashes on it; facts are on the left and may be split when a key is hot.
    """
    date = F.col(on_date) if isinstance(on_date, str) else on_date
    rows = history.withColumnRenamed(key, "_history_key")
    inside = (
        (F.col(key) == F.col("_history_key"))
        & (date >= F.col(valid_from))
        & (date < F.coalesce(F.col(valid_to), F.lit("9999-12-31").cast("date")))
    )
    return facts.join(rows, inside, "inner").drop("_history_key")


def as_of_join(
    facts: DataFrame, history: DataFrame, key: str, on_date: str, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """``point_in_time_join`` as a merge: each fact takes the history row of its key that began last before it.

    Facts and history are put in one order of key and time, dealt out by ranges
    of it, and the last history row is carried down to the facts. A key that
    lies in several ranges hands its last row on through a table of one row
    per range and such key. So a key with a third of all facts and history
    spreads over many tasks, and no fact meets more than one row of it.

    History rows of a key must not overlap, as in a slowly changing dimension;
    of those that begin together, the one that lasts longest counts. Facts and
    history rows without a key, and facts without a date, have no partner.
    """
    open_end = F.lit("9999-12-31").cast("date")
    rows = history.withColumnRenamed(key, "_history_key")
    of_history = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_history")
    of_fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact")
    began = rows.where(F.col("_history_key").isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col("_history_key").alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"),
        F.struct(F.coalesce(valid_to, open_end).alias("end"), F.lit(0).cast("long").alias("tie")).alias("_order"), of_history,
    )
    asked = facts.where(F.col(key).isNotNull() & F.col(on_date).isNotNull()).select(
        F.col(key).alias("_key"), F.col(on_date).alias("_at"), F.lit(1).alias("_kind"),
        # ties of one key and date spread, too
        F.struct(open_end.alias("end"), F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]).alias("tie")).alias("_order"), of_fact,
    )
    line = ["_key", "_at", "_kind", "_order"]
    events = began.unionByName(asked, allowMissingColumns=True)
    placed = staged(
        events.repartitionByRange(*line).sortWithinPartitions(*line).withColumn("_part", F.spark_partition_id()), "as-of-events"
    )
    last = F.max_by("_history", F.when(F.col("_kind") == 0, F.struct("_at", "_order")))
    borders = placed.groupBy("_key", "_part").agg(last.alias("_last"))
    parts = Window.partitionBy("_key").orderBy("_part")
    # keys of several ranges only: at most two for each range
    handed = (
        borders.withColumn("_ranges", F.count("*").over(Window.partitionBy("_key")))
        .where("_ranges > 1")
        .withColumn("_before", F.last("_last", ignorenulls=True).over(parts.rowsBetween(Window.unboundedPreceding, -1)))
        .where("_before IS NOT NULL")
        .select(F.col("_key").alias("_of_key"), F.col("_part").alias("_of_part"), "_before")
    )
    handed = staged(handed, "as-of-borders")
    down = Window.partitionBy("_part", "_key").orderBy("_at", "_kind", "_order").rowsBetween(Window.unboundedPreceding, 0)
    carried = placed.withColumn("_own", F.last("_history", ignorenulls=True).over(down)).where("_kind = 1")
    same = (F.col("_key") == F.col("_of_key")) & (F.col("_part") == F.col("_of_part"))
    met = carried.join(handed, same, "left").withColumn("_row", F.coalesce("_own", "_before"))
    found = met.where(F.col("_row").isNotNull() & (F.col("_at") < F.coalesce(F.col(f"_row.{valid_to}"), open_end)))
    return found.select("_fact.*", *[F.col(f"_row.`{c}`") for c in rows.columns if c != "_history_key"])


def without_match(rows: DataFrame, others: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows whose key no other row has.

    The others are reduced to their keys before the shuffle, so that a hot key
    among them arrives once per task and not once per row.
    """
    keys = others.select(F.col(other_key).alias("_other")).distinct()
    return rows.join(keys, F.col(key) == F.col("_other"), "left_anti")
