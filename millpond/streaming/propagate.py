"""Carry the changes of a table over to a filtered, narrower copy of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millpond.operators.dedup import last_per_key
from millpond.operators.merge import WhenMatched, WhenNotMatched
from millpond.operators.snapshot import SnapshotTable

# fixed values: the change types that state a row's condition after a change
AFTER_TYPES = ["update_postimage", "insert", "delete"]


def propagate(
    source: SnapshotTable, target: SnapshotTable, key: str, belongs: Column,
    starting_version: int, ending_version: int | None = None, at=None,
) -> int:
    """MERGE the last change per key into ``target``, whose rows are those where ``belongs``.

    A row that no longer belongs is deleted as well, so the feed is filtered
    only after the last change per key is known.
    """
    columns = [c for c in target.read().columns if c != key]
    feed = source.changes(starting_version, ending_version).where(F.col("_change_type").isin(AFTER_TYPES))
    stays = (F.col("_change_type") != "delete") & F.coalesce(belongs, F.lit(False))
    # within one version a key that was deleted and inserted again ends as inserted
    order = (F.col("_change_type") != "delete").cast("int")
    slim = feed.select(key, *columns, "_commit_version", order.alias("_order"), stays.alias("_stays"))
    latest = last_per_key(slim, [key], ["_commit_version", "_order"])
    return target.merge(
        latest, [key],
        matched=[
            WhenMatched("NOT s._stays", delete=True),
            WhenMatched(None, {c: F.col(f"s.{c}") for c in columns}),
        ],
        not_matched=[WhenNotMatched("s._stays")],
        at=at,
    )
