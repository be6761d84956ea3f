"""Filters, joins, aggregates, group comparisons, sorting and distinct over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators.dedup import duplicate_keys, first_per_key
from millpond.operators.groups import top_per_group, with_group_stats
from millpond.operators.joins import broadcast_checked, without_match
from millpond.operators.quality import count_where, layer_counts, write_counted
from millpond.queries.registry import query, table, view
from millpond.sources.generated import doubled
from millpond.workspace import new_path, staged


#: Values in one array of the smaller side of a product of domains, about.
LEVELS = 1000


# ---- filters and projections ---------------------------------------------


@query("filter_group_sort", """
    SELECT o_orderpriority, ROUND(AVG(o_totalprice), 2) AS avg_price, COUNT(*) AS order_count
    FROM orders WHERE o_totalprice > 80000 GROUP BY o_orderpriority ORDER BY avg_price DESC""")
def filter_group_sort(spark, sf):
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_totalprice") > 80000)
        .groupBy("o_orderpriority")
        .agg(F.round(F.avg("o_totalprice"), 2).alias("avg_price"), F.count("*").alias("order_count"))
        .orderBy(F.desc("avg_price"))
    )


@query("filter_gt", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def filter_gt(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.filter(F.col("o_totalprice") > 400000).select("o_orderkey", "o_custkey", "o_totalprice")


@query("select_alias", "SELECT c_name, c_mktsegment AS segment, c_acctbal AS balance_usd FROM customer")
def select_alias(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance_usd")
    )


@query("scan_parquet", """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R'""")
def scan_parquet(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R"))
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


@query("range_select", "SELECT o_orderkey AS id, o_orderkey * 2 AS doubled FROM orders")
def range_select(spark, sf):
    """The keys of all orders, each with its double."""
    return doubled(table(spark, sf, "orders").selectExpr("o_orderkey AS id"))


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("distinct_pairs", """
    SELECT DISTINCT c_mktsegment, c_nationkey FROM customer ORDER BY c_mktsegment, c_nationkey""")
def distinct_pairs(spark, sf):
    pairs = table(spark, sf, "customer").select("c_mktsegment", "c_nationkey")
    return pairs.distinct().orderBy("c_mktsegment", "c_nationkey")


# ---- aggregates -------------------------------------------------------------


@query("group_having_df", """
    SELECT c_nationkey, COUNT(*) AS headcount, ROUND(AVG(c_acctbal), 6) AS avg_balance,
           ROUND(SUM(c_acctbal), 2) AS total_balance
    FROM customer GROUP BY c_nationkey HAVING ROUND(AVG(c_acctbal), 6) > 4500""")
def group_having_df(spark, sf):
    return (
        table(spark, sf, "customer")
        .groupBy("c_nationkey")
        .agg(
            F.count("*").alias("headcount"),
            F.round(F.avg("c_acctbal"), 6).alias("avg_balance"),
            F.round(F.sum("c_acctbal"), 2).alias("total_balance"),
        )
        .filter(F.col("avg_balance") > 4500)
    )


@query("group_having_sql", """
    SELECT p_brand, COUNT(*) AS parts, ROUND(AVG(p_retailprice), 5) AS avg_price, SUM(p_size)::BIGINT AS total_size
    FROM part GROUP BY p_brand HAVING COUNT(*) > 75 ORDER BY p_brand""")
def group_having_sql(spark, sf):
    view(spark, sf, "part")
    return spark.sql("""
        SELECT p_brand, COUNT(*) AS parts, ROUND(AVG(p_retailprice), 5) AS avg_price, SUM(p_size) AS total_size
        FROM part GROUP BY p_brand HAVING parts > 75 ORDER BY p_brand""")


@query("group_count", "SELECT c_mktsegment, COUNT(*) AS customers FROM customer GROUP BY c_mktsegment")
def group_count(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("customers"))


@query("group_two_keys", """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS items FROM lineitem
    GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus""")
def group_two_keys(spark, sf):
    grouped = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return grouped.agg(F.count("*").alias("items")).orderBy("l_returnflag", "l_linestatus")


@query("layer_counts", """
    SELECT 'orders' AS layer, COUNT(*) AS row_count FROM orders
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
    UNION ALL SELECT 'completed', COUNT(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'by_priority', COUNT(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def layer_counts_query(spark, sf):
    orders = table(spark, sf, "orders")
    return layer_counts({
        "orders": orders,
        "lineitem": table(spark, sf, "lineitem"),
        "completed": orders.where(F.col("o_orderstatus") == "F"),
        "by_priority": orders.groupBy("o_orderpriority").count(),
    })


@query("high_watermark", """
    SELECT MAX(ts) AS max_ts, MAX(event_id) AS max_id, COUNT(*) AS event_count FROM events""")
def high_watermark(spark, sf):
    return table(spark, sf, "events").agg(
        F.max("ts").alias("max_ts"), F.max("event_id").alias("max_id"), F.count("*").alias("event_count")
    )


@query("duplicate_keys", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def duplicate_keys_query(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "copies")


@query("anomaly_counts", """
    SELECT COUNT(*) FILTER (value < 1) AS negligible, COUNT(*) FILTER (value > 300) AS high_value,
           COUNT(*) FILTER (event_type = 'error') AS errors, COUNT(*) FILTER (value - 5 <= 0) AS non_positive
    FROM events""")
def anomaly_counts(spark, sf):
    return count_where(
        table(spark, sf, "events"),
        negligible=F.col("value") < 1,
        high_value=F.col("value") > 300,
        errors=F.col("event_type") == "error",
        non_positive=F.col("value") - 5 <= 0,
    )


@query("observed_write", """
    SELECT COUNT(*) FILTER (value < 1) AS negligible, COUNT(*) FILTER (value > 300) AS high_value,
           COUNT(*) FILTER (event_type = 'error') AS errors, COUNT(*) AS rows, COUNT(event_id) AS written FROM events""")
def observed_write(spark, sf):
    """Events are written, and their anomalies counted on the way, in one job with one scan."""
    path = new_path(spark, "observed")
    events = table(spark, sf, "events")
    counts = write_counted(
        events, path,
        negligible=F.col("value") < 1, high_value=F.col("value") > 300, errors=F.col("event_type") == "error",
    )
    return spark.read.parquet(path).agg(
        *[F.lit(counts[name]).cast("long").alias(name) for name in ("negligible", "high_value", "errors", "rows")],
        F.count("event_id").alias("written"),
    )


@query("above_group_avg", """
    SELECT * FROM (
        SELECT c_custkey, c_mktsegment, c_acctbal,
               ROUND(AVG(c_acctbal) OVER (PARTITION BY c_mktsegment), 2) AS segment_avg FROM customer)
    WHERE c_acctbal > segment_avg""")
def above_group_avg(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    rated = with_group_stats(customers, ["c_mktsegment"], F.round(F.avg("c_acctbal"), 2).alias("segment_avg"))
    return rated.filter(F.col("c_acctbal") > F.col("segment_avg"))


@query("top_per_group", """
    SELECT p_type, p_brand, p_partkey, p_size FROM part
    WHERE (p_type, p_size) IN (SELECT (p_type, MAX(p_size)) FROM part GROUP BY p_type)""")
def top_per_group_query(spark, sf):
    parts = table(spark, sf, "part").select("p_type", "p_brand", "p_partkey", "p_size")
    return top_per_group(parts, ["p_type"], "p_size")


@query("top_per_group_sql", """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    WHERE (c_mktsegment, c_acctbal) IN (SELECT (c_mktsegment, MAX(c_acctbal)) FROM customer GROUP BY c_mktsegment)
          AND c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL
    ORDER BY c_mktsegment""")
def top_per_group_sql(spark, sf):
    """A pair with a NULL is in no list, so segments without a name or a balance have no top."""
    view(spark, sf, "customer")
    return spark.sql("""
        SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
        WHERE (c_mktsegment, c_acctbal) IN (
            SELECT c_mktsegment, MAX(c_acctbal) FROM customer GROUP BY c_mktsegment)
        ORDER BY c_mktsegment""")


@query("dedup_by_key", """
    SELECT doc_id, text, lang, source, n_chars FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1""")
def dedup_by_key(spark, sf):
    return first_per_key(table(spark, sf, "documents"), ["text"], ["doc_id"])


# ---- joins --------------------------------------------------------------------


@query("inner_join", """
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_join(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


def _rush_orders(spark, sf):
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return table(spark, sf, "orders").filter(urgent)


@query("left_join", """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN
        (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') ON c_custkey = o_custkey""")
def left_join(spark, sf):
    """Matches by an inner join, of which both sides can be split at a hot key; then the customers without any."""
    customer, rush = table(spark, sf, "customer"), _rush_orders(spark, sf)
    columns = ["c_custkey", "c_name", "o_orderkey", "o_totalprice"]
    matched = rush.join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner").select(*columns)
    alone = without_match(customer, rush, "c_custkey", "o_custkey")
    for name in columns[2:]:
        alone = alone.withColumn(name, F.lit(None).cast(rush.schema[name].dataType))
    return matched.unionByName(alone.select(*columns))


@query("full_outer_join", """
    SELECT COALESCE(u.custkey, h.custkey) AS custkey, u.orders AS urgent_orders, h.orders AS high_value_orders
    FROM (SELECT o_custkey AS custkey, COUNT(*) AS orders FROM orders
          WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY o_custkey) u
    FULL JOIN (SELECT o_custkey AS custkey, COUNT(*) AS orders FROM orders
          WHERE o_totalprice > 450000 GROUP BY o_custkey) h ON u.custkey = h.custkey""")
def full_outer_join(spark, sf):
    def per_customer(rows):
        return rows.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("orders"))

    urgent = per_customer(_rush_orders(spark, sf)).alias("u")
    high = per_customer(table(spark, sf, "orders").filter(F.col("o_totalprice") > 450000)).alias("h")
    return urgent.join(high, F.col("u.custkey") == F.col("h.custkey"), "full").select(
        F.coalesce("u.custkey", "h.custkey").alias("custkey"),
        F.col("u.orders").alias("urgent_orders"),
        F.col("h.orders").alias("high_value_orders"),
    )


@query("broadcast_join", """
    SELECT c_custkey, c_acctbal, n_name, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def broadcast_join(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        table(spark, sf, "customer")
        .join(broadcast_checked(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(broadcast_checked(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_acctbal", "n_name", "r_name")
    )


@query("sort_merge_join", """
    SELECT o_orderpriority, COUNT(*) AS items, ROUND(SUM(l_extendedprice), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def sort_merge_join(spark, sf):
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lineitem.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("items"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


@query("cross_join", """
    SELECT c_nationkey, priority, COALESCE(order_count, 0) AS order_count
    FROM (SELECT DISTINCT c_nationkey FROM customer)
    CROSS JOIN (SELECT DISTINCT o_orderpriority AS priority FROM orders)
    LEFT JOIN (SELECT c_nationkey AS nation, o_orderpriority AS level, COUNT(*) AS order_count
               FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)
    ON c_nationkey IS NOT DISTINCT FROM nation AND priority IS NOT DISTINCT FROM level""")
def cross_join(spark, sf):
    """Every nation of a customer with every priority of an order, including pairs without orders.

    The orders are counted per pair first, so that only the two domains are
    multiplied. Priorities travel in arrays of about ``LEVELS``, and each nation
    meets each array once.
    """
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    counted = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), F.col("o_orderpriority").alias("level"))
        .agg(F.count("*").alias("orders"))
    )
    levels = staged(orders.select("o_orderpriority").distinct(), "levels")
    arrays = levels.count() // LEVELS + 1
    part = F.pmod(F.xxhash64("o_orderpriority"), F.lit(arrays))
    # structs, since collected arrays leave NULLs out
    of_part = levels.groupBy(part.alias("part")).agg(F.collect_list(F.struct("o_orderpriority")).alias("levels"))
    nations = customer.select("c_nationkey").distinct()
    nations = nations.select("c_nationkey", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(arrays - 1).cast("long"))).alias("part"))
    pairs = nations.join(of_part, "part").select("c_nationkey", F.explode("levels").alias("level_of")).select(
        "c_nationkey", F.col("level_of.o_orderpriority").alias("priority")
    )
    same = F.col("c_nationkey").eqNullSafe(F.col("nation")) & F.col("priority").eqNullSafe(F.col("level"))
    return pairs.join(counted, same, "left").select(
        "c_nationkey", "priority", F.coalesce("orders", F.lit(0)).cast("long").alias("order_count")
    )


@query("left_anti", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def left_anti(spark, sf):
    customer = table(spark, sf, "customer")
    return without_match(customer, _rush_orders(spark, sf), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("left_anti_alias", """
    SELECT p_partkey AS partkey, p_name FROM part WHERE NOT EXISTS (
        SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 48)""")
def left_anti_alias(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), "p_name").alias("p")
    returned = (
        table(spark, sf, "lineitem")
        .filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 48))
        .select(F.col("l_partkey").alias("partkey"))
        .distinct()  # combined before the shuffle: a hot part arrives once per task
        .alias("r")
    )
    return parts.join(returned, F.col("p.partkey") == F.col("r.partkey"), "left_anti")


@query("using_join", """
    SELECT o_orderkey AS orderkey, o_orderdate::DATE AS order_date, l_linenumber, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""")
def using_join(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    items = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    items = items.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return orders.join(items, on="orderkey", how="inner")


def _suppliers_and_nations(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("nationkey"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return supplier, nation


@query("join_drop_dup", """
    SELECT s_suppkey, s_name, s_nationkey AS nationkey, n_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def join_drop_dup(spark, sf):
    supplier, nation = _suppliers_and_nations(spark, sf)
    joined = supplier.join(nation, supplier["nationkey"] == nation["nationkey"])
    return joined.drop(nation["nationkey"])


@query("join_alias", """
    SELECT s_suppkey, s_name, s_nationkey AS supplier_nation, n_nationkey AS nation_key, n_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def join_alias(spark, sf):
    supplier, nation = _suppliers_and_nations(spark, sf)
    joined = supplier.alias("s").join(nation.alias("n"), F.col("s.nationkey") == F.col("n.nationkey"))
    return joined.select(
        "s_suppkey", "s_name",
        F.col("s.nationkey").alias("supplier_nation"), F.col("n.nationkey").alias("nation_key"), "n_name",
    )


@query("join_rename", """
    SELECT s_suppkey, s_name, s_nationkey AS nationkey, n_name AS nation
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def join_rename(spark, sf):
    supplier, nation = _suppliers_and_nations(spark, sf)
    named = nation.withColumnRenamed("nationkey", "key").withColumnRenamed("n_name", "nation")
    return supplier.join(named, F.col("nationkey") == F.col("key")).drop("key")


@query("cached_base", """
    SELECT n_name, COUNT(*) AS order_count, ROUND(AVG(o_totalprice), 2) AS avg_price,
           SUM(COUNT(*)) OVER ()::BIGINT AS all_orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus = 'F' GROUP BY n_name""")
def cached_base(spark, sf):
    """One filtered, enriched base kept for several actions, then released."""
    nation = broadcast_checked(table(spark, sf, "nation"))
    base = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "o_totalprice")
        .persist()
    )
    completed = base.count()  # fills the cache
    summary = base.groupBy("n_name").agg(
        F.count("*").alias("order_count"), F.round(F.avg("o_totalprice"), 2).alias("avg_price")
    )
    result = staged(summary.withColumn("all_orders", F.lit(completed)), "cached-base")
    base.unpersist()
    return result
