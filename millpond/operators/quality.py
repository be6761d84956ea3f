"""Row rules: splits that lose nothing, counters in one pass, layer counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the rule is true, and all others (false or NULL)."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def broken_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Each row once per rule that does not hold for it (false or NULL), named in ``broken_rule``."""
    names = [F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("broken_rule", F.explode(F.array_compact(F.array(*names))))


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows meeting each condition, in a single scan."""
    return df.agg(
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in conditions.items()]
    )


def write_counted(df: DataFrame, path: str, **conditions: Column) -> dict[str, int]:
    """Write the rows to Parquet; the rows meeting each condition are counted in the same pass, ``rows`` counts all.

    The metrics are those of the tasks that wrote, so a task that is tried
    again counts once.
    """
    seen = Observation("counts")
    counts = [F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in conditions.items()]
    df.observe(seen, F.count("*").alias("rows"), *counts).write.mode("overwrite").parquet(path)
    return seen.get


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Name and number of rows of each layer."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)
