"""Files of a landing folder, each taken once as it arrives, with bad rows set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpond.sources.files import CORRUPT
from millpond.streaming.rows import _finish

CLEAN, BAD = "clean", "corrupt"


def _full(schema) -> T.StructType:
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def take_landed(
    spark: SparkSession, landing: str, taken: str, checkpoint: str, schema, timeout: int = 3600, files_per_batch: int = 1000, **options
) -> None:
    """Append the rows of delimited files not yet taken to a Parquet folder, then stop.

    The checkpoint knows the files, and the sink its batches: a file counts
    once, whether a run is repeated or breaks off midway. Rows that do not fit
    the schema keep their text in a part of their own. Files must appear whole
    in the folder and not change; names with a leading underscore wait.
    """
    rows = (
        spark.readStream.schema(_full(schema))
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")
        .option("recursiveFileLookup", "true")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**options)
        .csv(landing)
    )
    part = F.when(F.col(CORRUPT).isNull(), CLEAN).otherwise(BAD)
    query = (
        rows.select("*", F.col("_metadata.file_path").alias("_file"), part.alias("_part"))
        .writeStream.format("parquet")
        .partitionBy("_part")
        .option("path", taken)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query, timeout)


def read_taken(spark: SparkSession, taken: str, schema) -> tuple[DataFrame, DataFrame]:
    """Clean rows with the ``_file`` they came from, and the raw text of the others."""
    full = T.StructType([*_full(schema).fields, T.StructField("_file", T.StringType()), T.StructField("_part", T.StringType())])
    rows = spark.read.schema(full).parquet(taken)
    return rows.where(F.col("_part") == CLEAN).drop(CORRUPT, "_part"), rows.where(F.col("_part") == BAD).select(CORRUPT, "_file")
