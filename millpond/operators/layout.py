"""Partitioning, file counts and storage levels."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_BYTES = 128 * 1024 * 1024
FIXED_WIDTH = 16  # bytes allowed for a value that is not text


def file_count_for(total_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    """Number of files so that each holds about ``file_bytes``."""
    return max(1, math.ceil(total_bytes / file_bytes))


def measured_bytes(df: DataFrame) -> int:
    """The size of all rows: the lengths of text values and a fixed width for all others, in one aggregate."""
    width = F.lit(0)
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary", "varchar", "char"):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            width = width + F.octet_length(F.to_json(F.struct(F.col(field.name))))
        else:
            width = width + F.lit(FIXED_WIDTH)
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def spread_by(df: DataFrame, column: str) -> DataFrame:
    """Bring equal values together before a partitioned write.

    Adaptive execution merges small partitions and splits the one of a value
    holding many rows, so neither tiny files nor one overlong task result.
    """
    return df.hint("rebalance", column)


def layout_report(outputs: dict[str, DataFrame]) -> DataFrame:
    """Files, bytes and rows of each named, file-backed output."""
    report = None
    for name, df in outputs.items():
        per_file = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
            F.first("file_size").alias("file_size"), F.count("*").alias("file_rows")
        )
        line = per_file.agg(
            F.count("*").alias("files"), F.sum("file_size").alias("bytes"), F.sum("file_rows").alias("rows")
        ).select(F.lit(name).alias("output"), "files", "bytes", "rows")
        report = line if report is None else report.unionByName(line)
    return report
