"""Incremental loads by a high-water mark kept in a control table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpond.operators.intervals import VersionedRows
from millpond.workspace import staged


def control_table(spark: SparkSession, root: str, name: str, start: str) -> VersionedRows:
    """One mark per source; ``start`` is where the first load begins."""
    table = VersionedRows.create(spark, root, "table_name string, last_processed_timestamp timestamp")
    table.append(spark.range(1).select(
        F.lit(name).alias("table_name"), F.lit(start).cast("timestamp").alias("last_processed_timestamp")
    ))
    return table


def watermark(control: VersionedRows, name: str):
    """The mark of one source, as a typed value for a pushed-down comparison."""
    row = control.read().where(F.col("table_name") == name).first()
    return row.last_processed_timestamp


def incremental_load(
    source: DataFrame, sink: VersionedRows, control: VersionedRows, name: str, key: str, changed_at: str,
    undated: VersionedRows | None = None,
) -> int:
    """Append source rows changed since the mark, then move the mark. Returns the rows loaded.

    Rows at the mark itself are read again and checked against the sink's
    rows from there on, so a late row with the same time is not lost and a
    run repeated after a failure adds nothing twice. An empty run leaves the
    mark alone. Rows without a readable change time can never be placed by a
    mark: they replace the rows of ``undated``, and are refused if there is no
    such table.
    """
    at, mark = F.col(changed_at), F.lit(watermark(control, name))
    kind = source.schema[changed_at].dataType
    if isinstance(kind, T.StringType):
        at = at.try_cast("timestamp")
    else:
        mark = mark.cast(kind)  # the bare column can be pushed down to the scan
    lost = source.where(at.isNull())
    if undated is not None:
        undated.overwrite(lost)
    elif lost.take(1):
        raise ValueError(f"rows of {name} have no readable {changed_at}; give a table for them")
    recent = source.where(at >= mark)
    # written, since the planner cannot tell how few rows lie at or after the mark
    loaded = staged(sink.read().where(at >= mark).select(key, changed_at), "loaded")
    before = sink.current_version()
    after = sink.append(recent.join(loaded, [key, changed_at], "left_anti"), skip_empty=True)
    if after == before:
        return 0
    added = sink.appended_rows(before, after)
    found = added.agg(F.count("*").alias("rows"), F.max(at).cast("timestamp").alias("top")).first()
    control.update(F.col("table_name") == name, {"last_processed_timestamp": F.lit(found["top"])})
    return found["rows"]
