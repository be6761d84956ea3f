"""CSV, JSON and Parquet reading, with bad rows kept, dropped or refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpond.workspace import staged

CORRUPT = "_corrupt_record"


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession, path, schema=None, sep=",", header=True, null_value=None, mode="PERMISSIVE", **options
) -> DataFrame:
    """Delimited text with an explicit schema; without one the types are inferred by an extra pass.

    In the modes DROPMALFORMED and FAILFAST all columns are parsed once into a
    written table, since which rows are malformed must not depend on the
    columns a query happens to use. FAILFAST so raises here, at the read.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("mode", mode).options(**options)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    rows = reader.schema(_schema(schema)).csv(path)
    return rows if mode.upper() == "PERMISSIVE" else staged(rows, "csv-wellformed")


def read_csv_split(spark: SparkSession, path, schema, **options) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and the raw text of rows that do not fit the schema.

    All columns are parsed once into a written table: a query touching fewer
    columns parses fewer, and would miss bad rows.
    """
    full = T.StructType([*_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    rows = staged(
        read_csv(spark, path, full, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options), "csv-split"
    )
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_json(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    """JSON lines from a file, a folder or a glob; without a schema it is inferred."""
    reader = spark.read.options(**options)
    return (reader.schema(_schema(schema)) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def list_landing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, name, size and time of the files in a landing folder, without reading them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modification_time"),
    )
