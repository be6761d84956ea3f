"""MERGE on bucketed tables: the target lies in buckets of its key and does not shuffle, only the source does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.operators.merge import AmbiguousMerge, first_clause
from millpond.functions.scalars import as_column
from millpond.workspace import staged


def write_bucketed(df: DataFrame, name: str, on: list[str], buckets: int) -> None:
    """A catalog table in ``buckets`` buckets of its key, each sorted by it.

    Rows are dealt out as the buckets are, so each task writes the files of
    its own buckets. A hot key fills one bucket: keys of a MERGE target should
    be near to unique.
    """
    rows = df.repartition(buckets, *on)
    rows.write.mode("overwrite").bucketBy(buckets, *on).sortBy(*on).format("parquet").saveAsTable(name)


def merged_buckets(spark: SparkSession, name: str, source: DataFrame, on: list[str], matched=(), not_matched=()) -> DataFrame:
    """The rows of a bucketed table after a MERGE with a source whose keys are unique.

    Clauses are those of ``merge``: conditions and values name the target
    ``t`` and the source ``s``. The plan shuffles the source alone, into the
    buckets of the target. A NULL key meets nothing.
    """
    target = spark.table(name).withColumn("_old", F.lit(True))
    source = staged(source, "merge-source").withColumn("_new", F.lit(True))
    known = F.lit(True)
    for key in on:
        known &= F.col(key).isNotNull()
    if source.where(known).groupBy(*on).count().where("count > 1").take(1):
        raise AmbiguousMerge(f"several source rows share a key; make {on} unique")
    columns = [c for c in target.columns if c != "_old"]
    types = {f.name: f.dataType for f in target.schema.fields}
    same = F.lit(True)
    for key in on:
        same &= F.col(f"t.{key}") == F.col(f"s.{key}")
    # the merge hint keeps a small source from being broadcast to a full join that would then need another order
    pairs = target.alias("t").join(source.alias("s").hint("merge"), same, "full")
    met = F.col("t._old").isNotNull() & F.col("s._new").isNotNull()
    fires = F.when(met, first_clause(matched))
    enters = F.when(F.col("t._old").isNull(), first_clause(not_matched))
    gone = F.lit(False)
    values = {c: F.col(f"t.{c}") for c in columns}
    for at, clause in enumerate(matched):
        hit = fires == at
        if clause.delete:
            gone |= F.coalesce(hit, F.lit(False))
        for column, value in (clause.assign or {}).items():
            values[column] = F.when(hit, as_column(value).cast(types[column])).otherwise(values[column])
    for at, clause in enumerate(not_matched):
        for column in columns:
            if clause.values is None:
                value = F.col(f"s.{column}") if column in source.columns else F.lit(None)
            else:
                value = as_column(clause.values.get(column, F.lit(None)))
            values[column] = F.when(enters == at, value.cast(types[column])).otherwise(values[column])
    kept = ~gone & (F.col("t._old").isNotNull() | enters.isNotNull())
    return pairs.where(kept).select(*[values[c].alias(c) for c in columns])


def merge_bucketed(spark: SparkSession, name: str, source: DataFrame, on: list[str], buckets: int, matched=(), not_matched=()) -> None:
    """The same, written as the table's next state: into a new table that then takes the name."""
    spark.sql(f"DROP TABLE IF EXISTS {name}_next")
    rows = merged_buckets(spark, name, source, on, matched, not_matched)
    rows.repartition(buckets, *on).write.bucketBy(buckets, *on).sortBy(*on).format("parquet").saveAsTable(f"{name}_next")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {name}_next RENAME TO {name}")
