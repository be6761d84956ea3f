"""Writes to paths and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millpond.operators.layout import FILE_BYTES, file_count_for, measured_bytes, spread_by

#: Rows of a report that one task writes.
ONE_FILE_ROWS = 1_000_000


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, mode="overwrite"):
    """Parquet folder, optionally with one sub-folder per value."""
    if partition_by is None:
        df.write.mode(mode).parquet(path)
    else:
        spread_by(df, partition_by).write.mode(mode).partitionBy(partition_by).parquet(path)


def write_sized(df: DataFrame, path: str, total_bytes: int | None = None, file_bytes: int = FILE_BYTES, mode="overwrite"):
    """Parquet in the number of files that its size, measured unless given, calls for.

    The work before the write keeps its tasks.
    """
    size = measured_bytes(df) if total_bytes is None else total_bytes
    df.repartition(file_count_for(size, file_bytes)).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, sep=",", header=True, one_file=False, mode="overwrite", **options):
    """Delimited text. With ``one_file`` a single file, but one for each ``ONE_FILE_ROWS`` begun of a larger result."""
    # a shuffle, so that the work before the write keeps its tasks
    rows = df.repartition(max(1, -(-df.count() // ONE_FILE_ROWS))) if one_file else df
    rows.write.mode(mode).option("sep", sep).option("header", header).options(**options).csv(path)


def write_json(df: DataFrame, path: str, partition_by: str | None = None, mode="overwrite"):
    if partition_by is None:
        df.write.mode(mode).json(path)
    else:
        spread_by(df, partition_by).write.mode(mode).partitionBy(partition_by).json(path)


def save_managed(df: DataFrame, table: str, mode="overwrite"):
    """Managed Parquet table: the catalog owns the files and DROP removes them."""
    df.write.mode(mode).format("parquet").saveAsTable(table)


def register_external(spark: SparkSession, table: str, path: str):
    """Catalog entry over existing Parquet files: DROP leaves them in place."""
    spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION '{path}'")


def drop_if_exists(spark: SparkSession, *tables: str):
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
