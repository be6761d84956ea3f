"""The change rows of a versioned table as a stream: into a log, and into a filtered copy that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.operators.intervals import AFTER, DELETE, INSERT, VersionedRows, as_change_stream
from millpond.operators.merge import WhenMatched, WhenNotMatched
from millpond.workspace import new_path

#: The property of a following table that names the last batch it took.
TAKEN = "takenBatch"


def _finish(query, timeout: int) -> None:
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream did not end within {timeout} s; the next run goes on from its checkpoint")


def stream_log(
    table: VersionedRows, log: str, checkpoint: str, starting_version: int = 0, timeout: int = 3600, files_per_batch: int = 1000
) -> None:
    """Append all change rows not yet taken to a Parquet log, then stop.

    File source and file sink both keep their progress in the checkpoint, so a
    run that breaks off is continued without lost or repeated rows.
    """
    rows = as_change_stream(table, starting_version, lambda reader: reader.option("maxFilesPerTrigger", files_per_batch))
    query = (
        rows.writeStream.format("parquet")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query, timeout)


def read_stream_log(table: VersionedRows, log: str) -> DataFrame:
    """The log with the table's present columns."""
    schema = table.changes(1, 0).schema
    return table.spark.read.schema(schema).parquet(log).select(*schema.names)


def latest_per_key(feed: DataFrame, key: str, columns: list[str], belongs: Column) -> DataFrame:
    """The last state of each key in a feed: its ``columns``, and whether it ``_stays``.

    A streaming aggregate: the state holds the row of the greatest version per
    key, so versions that come late change nothing.
    """
    after = feed.where(F.col("_change_type").isin(AFTER, INSERT, DELETE))
    lives = F.col("_change_type") != DELETE
    stays = (lives & F.coalesce(belongs, F.lit(False))).alias("_stays")
    # within one version a key that was deleted and came in again ends as there
    order = F.struct("_commit_version", lives.cast("int").alias("_order"))
    row = F.struct(*[F.col(c) for c in columns], stays)
    return after.groupBy(key).agg(F.max_by(row, order).alias("_last")).select(key, "_last.*")


def follow(
    source: VersionedRows, target: VersionedRows, key: str, belongs: Column, checkpoint: str,
    starting_version: int, timeout: int = 3600, files_per_batch: int = 1000,
) -> None:
    """Bring a filtered, narrower copy up to date with all changes not yet taken, then stop.

    The rows of ``target`` are those where ``belongs``; one that no longer
    belongs is deleted. A batch and its number are one commit of the target, so
    a batch repeated after a failure is taken once.
    """
    columns = [c for c in target.schema().names if c != key]
    feed = as_change_stream(source, starting_version, lambda reader: reader.option("maxFilesPerTrigger", files_per_batch))
    latest = latest_per_key(feed, key, columns, belongs)

    def take(batch: DataFrame, number: int) -> None:
        if int(target.properties().get(TAKEN, -1)) >= number:
            return
        path = new_path(target.spark, "followed")  # written and read, since a batch has a session of its own
        batch.write.parquet(path)
        target.merge(
            target.spark.read.schema(batch.schema).parquet(path), [key],
            matched=[
                WhenMatched("NOT s._stays", delete=True),
                WhenMatched(None, {c: F.col(f"s.{c}") for c in columns}),
            ],
            not_matched=[WhenNotMatched("s._stays")],
            properties={TAKEN: str(number)}, unique=True,
        )

    query = (
        latest.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query, timeout)
