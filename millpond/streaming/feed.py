"""The change feed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators.snapshot import COMMIT_SCHEMA, SnapshotTable

COMMITS_PER_BATCH = 1000


def stream_changes(table: SnapshotTable, log_path: str, checkpoint: str, starting_version: int = 0, timeout: int = 3600) -> None:
    """Append all change rows committed since the last run to a Parquet log, then stop (after ``timeout`` seconds at most).

    The stream follows the commit rows, which appear last, so rows of an
    unfinished operation are never taken and no version is skipped. A batch
    repeated after a failure overwrites its own folder of the log.
    """
    commits = (
        table.spark.readStream.schema(COMMIT_SCHEMA)
        .option("maxFilesPerTrigger", COMMITS_PER_BATCH)
        .json(f"{table.root}/commits")
        .where(F.col("changes").isNotNull() & (F.col("version") >= starting_version))
        .select("changes")
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        folders = [r.changes for r in batch.collect()]
        if folders:
            table.change_rows(folders).write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    query = (
        commits.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream did not end within {timeout} s; the next run goes on from its checkpoint")


def read_log(table: SnapshotTable, log_path: str) -> DataFrame:
    """The log with the table's present columns."""
    schema = table.change_rows([]).schema
    return table.spark.read.schema(schema).parquet(log_path).select(*schema.names)
