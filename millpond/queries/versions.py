"""Versions, time travel, row mutations, schema changes and layout of a versioned table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators.diff import version_diff, version_diff_full
from millpond.operators.digests import digest_diff, write_digested
from millpond.operators.intervals import VersionedRows
from millpond.operators.quality import broken_rules, split_valid
from millpond.operators.snapshot import FEED_PROPERTY, SnapshotTable
from millpond.plans.recovery import recover, totals
from millpond.queries.registry import query, table
from millpond.workspace import new_path

SPLIT = "1998-01-01"
INFLATED_FROM = "2000-01-01"


def _before(date: str):
    return F.col("o_orderdate") < F.lit(date).cast("timestamp_ntz")


def _early():
    """Whether an order belongs to the first load; the undated ones come with the second."""
    return F.coalesce(_before(SPLIT), F.lit(False))


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _orders_table(spark, sf) -> VersionedRows:
    """All orders as version 0."""
    return VersionedRows.write(spark, new_path(spark, "orders"), _orders(spark, sf))


def _orders_story(spark, sf) -> VersionedRows:
    """v0 empty, v1 older orders, v2 all orders, v3 late prices times 100 by mistake."""
    orders = _orders(spark, sf)
    story = VersionedRows.create(spark, new_path(spark, "story"), orders.schema, at="2024-01-01 00:00:00")
    story.append(orders.where(_early()), at="2024-01-02 00:00:00")
    story.append(orders.where(~_early()), at="2024-01-03 00:00:00")
    story.update(~_before(INFLATED_FROM), {"o_totalprice": "o_totalprice * 100"}, at="2024-01-04 00:00:00")
    return story


def _batches(rows, key: str, count: int) -> list:
    """The rows in batches by a hash of their key; every row, also one without a key, is in one batch."""
    return [rows.where(F.pmod(F.xxhash64(key), F.lit(count)) == i) for i in range(count)]


# ---- scans, writes, appends ------------------------------------------------------


@query("snapshot_read", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def snapshot_read(spark, sf):
    rows = _orders_table(spark, sf).read()
    return rows.where(F.col("o_totalprice") > 300000).select("o_orderkey", "o_totalprice")


@query("snapshot_overwrite", """
    SELECT o_orderpriority, COUNT(*) AS order_count FROM orders GROUP BY o_orderpriority""")
def snapshot_overwrite(spark, sf):
    orders = _orders_table(spark, sf)
    orders.overwrite(orders.read().groupBy("o_orderpriority").agg(F.count("*").alias("order_count")))
    return orders.read()


@query("snapshot_append", "SELECT o_orderstatus, COUNT(*) AS order_count FROM orders GROUP BY o_orderstatus")
def snapshot_append(spark, sf):
    orders = _orders(spark, sf)
    grown = VersionedRows.create(spark, new_path(spark, "append"), orders.schema)
    for batch in _batches(orders, "o_orderkey", 3):
        grown.append(batch)
    return grown.read().groupBy("o_orderstatus").agg(F.count("*").alias("order_count"))


# ---- row mutations ------------------------------------------------------------------


@query("update_literal", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END AS o_orderstatus
    FROM orders""")
def update_literal(spark, sf):
    orders = _orders_table(spark, sf)
    orders.update("o_orderpriority = '1-URGENT'", {"o_orderstatus": "'U'"})
    return orders.read().select("o_orderkey", "o_orderstatus")


@query("update_multi", """
    SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'S' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_totalprice < 50000 THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def update_multi(spark, sf):
    orders = _orders_table(spark, sf)
    orders.update(F.col("o_totalprice") < 50000, {"o_orderstatus": "'S'", "o_orderpriority": "'5-LOW'"})
    return orders.read().select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("update_expr", """
    SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice * 100
        ELSE o_totalprice END AS o_totalprice FROM orders""")
def update_expr(spark, sf):
    orders = _orders_table(spark, sf)
    orders.update(~_before(INFLATED_FROM), {"o_totalprice": F.col("o_totalprice") * 100})
    return orders.read().select("o_orderkey", "o_totalprice")


@query("delete_rows", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE NOT COALESCE(o_orderstatus = 'P' AND o_totalprice < 250000, false)""")
def delete_rows(spark, sf):
    """Rows of which the condition is unknown stay."""
    orders = _orders_table(spark, sf)
    orders.delete("o_orderstatus = 'P' AND o_totalprice < 250000")
    return orders.read().select("o_orderkey", "o_orderstatus", "o_totalprice")


def _soft_deleted(spark, sf) -> VersionedRows:
    customers = VersionedRows.write(spark, new_path(spark, "soft-delete"), table(spark, sf, "customer"))
    customers.add_columns("is_deleted boolean")
    customers.update("is_deleted IS NULL AND c_acctbal IS NOT NULL", {"is_deleted": "false"})
    customers.update("c_acctbal < 0", {"is_deleted": "true", "c_mktsegment": "'DELETED'"})
    return customers


@query("soft_delete_active", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE NOT COALESCE(c_acctbal < 0, false)""")
def soft_delete_active(spark, sf):
    """Customers without a balance are not deleted."""
    rows = _soft_deleted(spark, sf).read()
    return rows.where("is_deleted = false OR is_deleted IS NULL").select("c_custkey", "c_name", "c_mktsegment")


@query("soft_delete_audit", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DELETED' ELSE c_mktsegment END AS c_mktsegment,
           c_acctbal < 0 AS is_deleted FROM customer""")
def soft_delete_audit(spark, sf):
    return _soft_deleted(spark, sf).read().select("c_custkey", "c_mktsegment", "is_deleted")


# ---- versions and time travel ----------------------------------------------------------


_STORY_SQL = """
    WITH v1 AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         v2 AS (SELECT * FROM orders),
         v3 AS (SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice * 100
                ELSE o_totalprice END AS o_totalprice) FROM orders)
"""


@query("version_counts", _STORY_SQL + """
    SELECT 0::BIGINT AS version, 0::BIGINT AS row_count UNION ALL SELECT 1, COUNT(*) FROM v1
    UNION ALL SELECT 2, COUNT(*) FROM v2 UNION ALL SELECT 3, COUNT(*) FROM v3""")
def version_counts(spark, sf):
    story = _orders_story(spark, sf)
    parts = [
        story.read(version=v).agg(F.count("*").alias("row_count")).select(
            F.lit(v).cast("long").alias("version"), "row_count"
        )
        for v in range(4)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("history_ops", """
    SELECT unnest([0, 1, 2, 3, 4])::BIGINT AS version,
           unnest(['CREATE TABLE', 'APPEND', 'APPEND', 'UPDATE', 'DELETE']) AS operation
    FROM (SELECT COUNT(*) FROM orders)""")
def history_ops(spark, sf):
    story = _orders_story(spark, sf)
    story.delete("o_orderstatus = 'F'")
    return story.history().select("version", "operation")


@query("table_detail", """
    SELECT 'parquet' AS format, 3::BIGINT AS version, true AS has_files, COUNT(*) AS row_count, '90' AS retention
    FROM orders""")
def table_detail(spark, sf):
    orders = _orders(spark, sf)
    made = SnapshotTable.create(spark, new_path(spark, "detail"), orders.schema, {"owner": "sales"})
    made.append(orders.where(_early()))
    made.append(orders.where(~_early()))
    made.set_properties({"retentionDays": "90"})
    rows = made.read().count()
    return made.detail().select(
        "format", "version", (F.col("num_files") > 0).alias("has_files"),
        F.lit(rows).cast("long").alias("row_count"), F.col("properties")["retentionDays"].alias("retention"),
    )


@query("as_of_version", _STORY_SQL + """
    SELECT o_orderkey, o_totalprice FROM v1""")
def as_of_version(spark, sf):
    return _orders_story(spark, sf).read(version=1).select("o_orderkey", "o_totalprice")


@query("as_of_timestamp", _STORY_SQL + """
    SELECT 'before update' AS at, COUNT(*) AS row_count, ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE AS total FROM v2
    UNION ALL SELECT 'first load', COUNT(*), ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE FROM v1""")
def as_of_timestamp(spark, sf):
    story = _orders_story(spark, sf)
    later = totals(story.read(timestamp="2024-01-03 12:00:00"), "o_totalprice")
    first = totals(story.read(timestamp="2024-01-02 00:00:00"), "o_totalprice")
    return later.select(F.lit("before update").alias("at"), "*").unionByName(
        first.select(F.lit("first load").alias("at"), "*")
    )


@query("snapshot_totals", _STORY_SQL + """
    SELECT 1::BIGINT AS version, COUNT(*) AS row_count, ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE AS total FROM v1
    UNION ALL SELECT 2, COUNT(*), ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE FROM v2
    UNION ALL SELECT 3, COUNT(*), ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE FROM v3""")
def snapshot_totals(spark, sf):
    story = _orders_story(spark, sf)
    one, two, three = [
        totals(story.read(version=v), "o_totalprice").select(F.lit(v).cast("long").alias("version"), "*")
        for v in (1, 2, 3)
    ]
    return one.unionByName(two).unionByName(three)


@query("restore", "SELECT * FROM orders")
def restore(spark, sf):
    story = _orders_story(spark, sf)
    story.restore(2)
    return story.read()


@query("clone_version", _STORY_SQL + "SELECT * FROM v1")
def clone_version(spark, sf):
    story = _orders_story(spark, sf)
    return story.clone(new_path(spark, "clone"), version=1).read()


@query("current_version", """
    SELECT 3::BIGINT AS current_version, COUNT(*) AS row_count FROM orders""")
def current_version(spark, sf):
    story = _orders_story(spark, sf)
    latest = story.history().agg(F.max("version")).first()[0]
    return story.read(version=latest).agg(
        F.lit(latest).cast("long").alias("current_version"), F.count("*").alias("row_count")
    )


@query("version_diff", _STORY_SQL + """
    SELECT v3.o_orderkey, v3.o_totalprice AS current_o_totalprice, v2.o_totalprice AS previous_o_totalprice
    FROM v3 JOIN v2 USING (o_orderkey) WHERE v3.o_totalprice != v2.o_totalprice""")
def version_diff_query(spark, sf):
    return version_diff(_orders_story(spark, sf), 2, 3, "o_orderkey", "o_totalprice")


@query("version_diff_full", _STORY_SQL + """
    SELECT v3.o_orderkey, CASE WHEN v1.o_orderkey IS NULL THEN 'added' ELSE 'removed' END AS diff,
           v1.o_totalprice AS old_price, v3.o_totalprice AS new_price
    FROM v3 LEFT JOIN v1 USING (o_orderkey) WHERE v1.o_orderkey IS NULL AND v3.o_orderstatus IS DISTINCT FROM 'P'
    UNION ALL SELECT o_orderkey, 'removed', o_totalprice, NULL FROM v1 WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'changed', o_totalprice, -o_totalprice FROM v1
    WHERE o_orderstatus = 'O' AND o_totalprice IS NOT NULL""")
def version_diff_full_query(spark, sf):
    """Version 1 against a version with rows added, removed and changed."""
    story = _orders_story(spark, sf)
    story.delete("o_orderstatus = 'P'")
    story.update(_before(SPLIT) & (F.col("o_orderstatus") == "O"), {"o_totalprice": "-o_totalprice"})
    return version_diff_full(story, 1, story.current_version(), "o_orderkey").select(
        "o_orderkey", "diff", F.col("old_o_totalprice").alias("old_price"), F.col("new_o_totalprice").alias("new_price")
    )


@query("digest_diff", """
    SELECT o_orderkey, 'changed' AS diff, o_totalprice AS old_price, o_totalprice + 1 AS new_price FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_custkey % 50 = 0 AND o_totalprice IS NOT NULL
    UNION ALL SELECT o_orderkey, 'removed', o_totalprice, NULL FROM orders
    WHERE o_orderpriority = '2-HIGH' AND o_custkey % 50 = 1""")
def digest_diff_query(spark, sf):
    """Two stored tables without a common history, compared by digests of their buckets."""
    orders = _orders(spark, sf)
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 50 == 0)
    gone = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_custkey") % 50 == 1)
    price = F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    changed = orders.where(~F.coalesce(gone, F.lit(False))).withColumn("o_totalprice", price)
    old, new = new_path(spark, "digested-old"), new_path(spark, "digested-new")
    write_digested(orders, old, "o_orderkey", 32)
    write_digested(changed, new, "o_orderkey", 32)
    return digest_diff(spark, old, new, "o_orderkey").select(
        "o_orderkey", "diff", F.col("old_o_totalprice").alias("old_price"), F.col("new_o_totalprice").alias("new_price")
    )


@query("recovery_totals", _STORY_SQL + """
    SELECT 'damaged' AS state, COUNT(*) AS row_count, ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE AS total FROM v3
    UNION ALL SELECT 'restored', COUNT(*), ROUND(SUM(o_totalprice::DECIMAL(38, 6)), 2)::DOUBLE FROM v2""")
def recovery_totals(spark, sf):
    story = _orders_story(spark, sf)
    recover(story, 2, "o_orderkey")
    damaged = totals(story.read(version=3), "o_totalprice").select(F.lit("damaged").alias("state"), "*")
    return damaged.unionByName(totals(story.read(), "o_totalprice").select(F.lit("restored").alias("state"), "*"))


# ---- schema, layout, clean-up --------------------------------------------------------------


@query("merge_schema", """
    SELECT p_partkey, p_retailprice, CASE WHEN p_size > 25 THEN p_type END AS category FROM part""")
def merge_schema(spark, sf):
    parts = table(spark, sf, "part")
    slim = parts.select("p_partkey", "p_retailprice", "p_size")
    large = F.coalesce(F.col("p_size") > 25, F.lit(False))  # parts without a size come first
    grown = VersionedRows.write(spark, new_path(spark, "merge-schema"), slim.where(~large).drop("p_size"))
    wide = parts.where(large).select("p_partkey", "p_retailprice", F.col("p_type").alias("category"))
    grown.append(wide, merge_schema=True)
    return grown.read()


@query("add_columns", """
    SELECT p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN p_size END AS stock_count, NULL::VARCHAR AS supplier
    FROM part""")
def add_columns(spark, sf):
    parts = table(spark, sf, "part")
    made = VersionedRows.write(spark, new_path(spark, "add-columns"), parts)
    made.add_columns("stock_count int, supplier string")
    made.update("p_type = 'PROMO'", {"stock_count": "p_size"})
    return made.read().select("p_partkey", "p_name", "stock_count", "supplier")


@query("describe", """
    SELECT unnest(['p_partkey', 'p_name', 'category']) AS col_name,
           unnest(['bigint', 'string', 'string']) AS data_type FROM (SELECT COUNT(*) FROM part)""")
def describe(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    made = SnapshotTable.write(spark, new_path(spark, "describe"), parts)
    made.add_columns("category string")
    return made.describe().select("col_name", "data_type")


@query("checked_append", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0")
def checked_append(spark, sf):
    """Rows pass a CHECK on their way in."""
    orders = _orders(spark, sf).select("o_orderkey", "o_totalprice")
    made = VersionedRows.create(spark, new_path(spark, "checked"), orders.schema)
    made.add_constraint("positive_price", "o_totalprice > 0")
    valid, _ = split_valid(orders, F.col("o_totalprice") > 0)
    made.append(valid)
    return made.read()


ORDER_RULES = {"price_floor": "o_totalprice > 50000", "closed": "o_orderstatus <> 'P'", "prioritised": "o_orderpriority <> '5-LOW'"}


@query("refused_rows", """
    SELECT o_orderkey, 'price_floor' AS broken_rule FROM orders WHERE NOT COALESCE(o_totalprice > 50000, false)
    UNION ALL SELECT o_orderkey, 'closed' FROM orders WHERE NOT COALESCE(o_orderstatus <> 'P', false)
    UNION ALL SELECT o_orderkey, 'prioritised' FROM orders WHERE NOT COALESCE(o_orderpriority <> '5-LOW', false)""")
def refused_rows(spark, sf):
    """Rows that rules refuse, with each rule they break, in one scan."""
    return broken_rules(_orders(spark, sf), ORDER_RULES).select("o_orderkey", "broken_rule")


@query("optimize_same_rows", "SELECT * FROM orders")
def optimize_same_rows(spark, sf):
    """All changes folded into interval rows in the order of the customers."""
    story = _orders_story(spark, sf)
    story.restore(2)
    story.fold(cluster_by="o_custkey")
    return story.read()


@query("compacted_layout", """
    SELECT 'APPEND' AS last_append, 'OPTIMIZE' AS operation, true AS fewer_files, COUNT(*) AS row_count FROM orders""")
def compacted_layout(spark, sf):
    """Many small appends packed into fewer files."""
    orders = _orders(spark, sf)
    made = SnapshotTable.create(spark, new_path(spark, "compact"), orders.schema)
    for batch in _batches(orders, "o_orderkey", 5):
        made.append(batch)
    before = made.detail().first().num_files
    last = made.commit().operation
    made.optimize()
    return made.read().agg(F.count("*").alias("row_count")).select(
        F.lit(last).alias("last_append"), F.lit(made.commit().operation).alias("operation"),
        F.lit(made.detail().first().num_files < before).alias("fewer_files"), "row_count",
    )


@query("vacuum_candidates", """
    SELECT 'candidates' AS state, COUNT(*) > 0 AS has_files FROM orders
    UNION ALL SELECT 'inside window', false UNION ALL SELECT 'after vacuum', false
    UNION ALL SELECT 'current readable', COUNT(*) > 0 FROM orders""")
def vacuum_candidates(spark, sf):
    """Files only old versions need: found without a window, kept by the default one, then removed."""
    orders = SnapshotTable.write(spark, new_path(spark, "orders"), _orders(spark, sf))
    orders.delete("o_orderstatus = 'F'")
    found = orders.vacuum(retain_hours=0, dry_run=True, force=True).count()
    inside = orders.vacuum(dry_run=True).count()
    orders.vacuum(retain_hours=0, force=True)
    after = orders.vacuum_candidates(0).count()
    rows = orders.read().count()
    states = {"candidates": found, "inside window": inside, "after vacuum": after, "current readable": rows}
    return spark.createDataFrame([(k, v > 0) for k, v in states.items()], "state string, has_files boolean")


@query("feed_property", """
    SELECT 'true' AS feed, COUNT(*) AS changes FROM part WHERE p_type = 'PROMO'""")
def feed_property(spark, sf):
    """Only changes after the feed is switched on are recorded."""
    parts = table(spark, sf, "part")
    made = SnapshotTable.write(spark, new_path(spark, "feed-property"), parts)
    made.update("p_type = 'SMALL'", {"p_size": "0"})
    made.set_properties({FEED_PROPERTY: "true"})
    made.delete("p_type = 'PROMO'")
    feed = made.detail().first().properties[FEED_PROPERTY]
    return made.changes().agg(F.lit(feed).alias("feed"), F.count("*").alias("changes"))
