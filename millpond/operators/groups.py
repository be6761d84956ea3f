"""Row-against-group comparisons without a window.

The group values are aggregated (with partial sums before the shuffle) and
written as a small table; the rows then join to it. Below the planner's
broadcast threshold, measured on the written bytes, the rows do not shuffle at
all; above it the join shuffles and adaptive execution splits hot groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.workspace import staged


def with_group_stats(df: DataFrame, keys: list[str], *stats: Column) -> DataFrame:
    """Each row with aggregates of its group (the ``OVER (PARTITION BY keys)`` result)."""
    columns = df.columns
    per_group = staged(df.groupBy(*keys).agg(*stats), "group-stats")
    added = [c for c in per_group.columns if c not in keys]
    same = None
    for key in keys:
        test = F.col(f"r.{key}").eqNullSafe(F.col(f"g.{key}"))
        same = test if same is None else same & test
    joined = df.alias("r").join(per_group.alias("g"), same, "left")
    return joined.select(*[F.col(f"r.{c}") for c in columns], *[F.col(f"g.{c}") for c in added])


def top_per_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows holding the greatest ``value`` of their group, ties included; in a group of NULLs alone all rows."""
    best = staged(df.groupBy(*keys).agg(F.max(value).alias(value)), "group-max").alias("g")
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"g.{name}")) for name in [*keys, value]]
    return df.alias("r").join(best, same, "left_semi")
