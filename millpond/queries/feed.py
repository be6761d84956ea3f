"""The change feed of a table of parts: batch, by range and type, streamed, and propagated."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators.intervals import VersionedRows
from millpond.queries.registry import query, table
from millpond.streaming.rows import follow, read_stream_log, stream_log
from millpond.workspace import new_path

COLUMNS = ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"]
#: Parts of the second load; those without a size come with the first.
_LARGE = "COALESCE(p_size > 40, false)"
SHOWN = ["p_partkey", "p_type", "p_retailprice", "_change_type", "_commit_version"]


def _create(spark, sf):
    """v0 empty, v1 parts up to size 40."""
    parts = table(spark, sf, "part").select(*COLUMNS)
    made = VersionedRows.create(spark, new_path(spark, "parts"), parts.schema)
    made.append(parts.where(f"NOT {_LARGE}"))
    return made, parts


def _change(made, parts):
    """v2 raises a price, v3 changes a type, v4 deletes, v5 adds the larger parts."""
    made.update("p_type = 'PROMO'", {"p_retailprice": "p_retailprice + 100"})
    made.update("p_type = 'PROMO' AND p_size < 10", {"p_type": "'STANDARD'"})
    made.delete("p_type = 'ECONOMY' AND p_size > 30")
    made.append(parts.where(_LARGE))


def _story(spark, sf):
    made, parts = _create(spark, sf)
    _change(made, parts)
    return made


_FEED_SQL = """
    WITH feed AS (
        SELECT p_partkey, p_type, p_retailprice, 'insert' AS _change_type, 1::BIGINT AS _commit_version
        FROM part WHERE COALESCE(p_size <= 40, true)
        UNION ALL SELECT p_partkey, p_type, p_retailprice, 'update_preimage', 2 FROM part
        WHERE COALESCE(p_size <= 40, true) AND p_type = 'PROMO'
        UNION ALL SELECT p_partkey, p_type, p_retailprice + 100, 'update_postimage', 2 FROM part
        WHERE COALESCE(p_size <= 40, true) AND p_type = 'PROMO'
        UNION ALL SELECT p_partkey, p_type, p_retailprice + 100, 'update_preimage', 3 FROM part
        WHERE p_size < 10 AND p_type = 'PROMO'
        UNION ALL SELECT p_partkey, 'STANDARD', p_retailprice + 100, 'update_postimage', 3 FROM part
        WHERE p_size < 10 AND p_type = 'PROMO'
        UNION ALL SELECT p_partkey, p_type, p_retailprice, 'delete', 4 FROM part
        WHERE p_size > 30 AND p_size <= 40 AND p_type = 'ECONOMY'
        UNION ALL SELECT p_partkey, p_type, p_retailprice, 'insert', 5 FROM part WHERE p_size > 40)
"""


@query("cdf_all", _FEED_SQL + "SELECT * FROM feed")
def cdf_all(spark, sf):
    return _story(spark, sf).changes(starting_version=1).select(*SHOWN)


@query("cdf_range", _FEED_SQL + "SELECT * FROM feed WHERE _commit_version BETWEEN 2 AND 3")
def cdf_range(spark, sf):
    return _story(spark, sf).changes(starting_version=2, ending_version=3).select(*SHOWN)


@query("cdf_by_type", _FEED_SQL + """
    SELECT 'current values' AS route, p_partkey, p_retailprice, _commit_version FROM feed
    WHERE _change_type = 'update_postimage'
    UNION ALL SELECT 'removed', p_partkey, p_retailprice, _commit_version FROM feed WHERE _change_type = 'delete'
    UNION ALL SELECT 'added', p_partkey, p_retailprice, _commit_version FROM feed WHERE _change_type = 'insert'""")
def cdf_by_type(spark, sf):
    feed = _story(spark, sf).changes(starting_version=1)

    def route(name, kind):
        return feed.filter(f"_change_type = '{kind}'").select(
            F.lit(name).alias("route"), "p_partkey", "p_retailprice", "_commit_version"
        )

    routes = route("current values", "update_postimage").unionByName(route("removed", "delete"))
    return routes.unionByName(route("added", "insert"))


@query("cdf_stream_log", _FEED_SQL + "SELECT * FROM feed")
def cdf_stream_log(spark, sf):
    """Streamed after the first load and again after the changes; the second run takes only new versions."""
    made, parts = _create(spark, sf)
    log, checkpoint = new_path(spark, "feed-log"), new_path(spark, "feed-checkpoint")
    stream_log(made, log, checkpoint, starting_version=1)
    _change(made, parts)
    stream_log(made, log, checkpoint, starting_version=1)
    return read_stream_log(made, log).select(*SHOWN)


@query("cdf_propagate", """
    SELECT p_partkey, p_name, p_retailprice + CASE WHEN COALESCE(p_size <= 40, true) THEN 100 ELSE 0 END AS p_retailprice
    FROM part WHERE p_type = 'PROMO' AND NOT COALESCE(p_size < 10, false)""")
def cdf_propagate(spark, sf):
    """A copy of the PROMO parts follows the feed as a stream, including parts that stop being PROMO, over a restart."""
    made, parts = _create(spark, sf)
    promo = F.col("p_type") == "PROMO"
    summary = made.read().where(promo).select("p_partkey", "p_name", "p_retailprice")
    copy = VersionedRows.write(spark, new_path(spark, "promo"), summary)
    checkpoint = new_path(spark, "promo-checkpoint")
    made.update("p_type = 'PROMO'", {"p_retailprice": "p_retailprice + 100"})
    follow(made, copy, "p_partkey", promo, checkpoint, starting_version=2)
    made.update("p_type = 'PROMO' AND p_size < 10", {"p_type": "'STANDARD'"})
    made.delete("p_type = 'ECONOMY' AND p_size > 30")
    made.append(parts.where(_LARGE))
    follow(made, copy, "p_partkey", promo, checkpoint, starting_version=2)
    return copy.read()
