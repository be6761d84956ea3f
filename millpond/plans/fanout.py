"""Several summaries of one enriched base, from a single scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.operators.joins import broadcast_checked
from millpond.workspace import staged


def enrich(facts: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Facts with the columns of a small lookup on a shared key."""
    return facts.join(broadcast_checked(lookup), on=on, how="inner")


def fanout(
    facts: DataFrame, lookup: DataFrame, on: str, good: Column,
    keys: dict[str, list[str]], measures: list[Column], out_path: str,
) -> tuple[dict[str, DataFrame], int]:
    """Count bad rows, enrich the good ones and write one summary per key list.

    GROUPING SETS make all summaries in one pass with partial aggregation, so
    the base is neither cached nor read twice. The state of a row, which is
    part of every set and of one set of its own, carries the bad rows along;
    their count stays exact when lost tasks run again. Returns the written
    summaries and the bad count.
    """
    state = F.when(~F.coalesce(good, F.lit(False)), "bad").when(F.col("_known"), "good").otherwise("unknown")
    known = broadcast_checked(lookup.withColumn("_known", F.lit(True)))
    base = facts.join(known, on=on, how="left").withColumn("_state", state).drop("_known")
    every = ["_state", *dict.fromkeys(k for ks in keys.values() for k in ks)]
    sets = [["_state", *ks] for ks in keys.values()] + [["_state"]]
    summary = staged(
        base.groupingSets([[F.col(k) for k in ks] for ks in sets], *[F.col(k) for k in every])
        .agg(F.grouping_id().alias("_set"), F.count("*").alias("_rows"), *measures),
        "fanout",
    )
    alone = (1 << (len(every) - 1)) - 1  # all keys but the state are left out
    counted = summary.where((F.col("_set") == alone) & (F.col("_state") == "bad")).agg(F.sum("_rows")).first()
    bad = counted[0] or 0
    written = {}
    for name, ks in keys.items():
        # grouping_id has a set bit for each key, first key highest, that is left out
        gone = [k for k in every if k not in ks and k != "_state"]
        number = sum(1 << (len(every) - 1 - every.index(k)) for k in gone)
        own = summary.where((F.col("_set") == number) & (F.col("_state") == "good"))
        own.drop("_set", "_rows", "_state", *gone).write.mode("overwrite").parquet(
            f"{out_path}/{name}"
        )
        written[name] = facts.sparkSession.read.parquet(f"{out_path}/{name}")
    return written, bad
