"""Bronze to gold, incremental loads and the summaries of one base."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators.quality import layer_counts
from millpond.operators.intervals import VersionedRows
from millpond.plans.fanout import fanout
from millpond.plans.incremental import control_table, incremental_load
from millpond.plans.medallion import open_layers, parse_bronze, refresh, split_orders
from millpond.operators.dedup import duplicate_keys
from millpond.queries.registry import query, table
from millpond.sources.generated import REGIONS
from millpond.workspace import new_path


# ---- bronze, silver, gold ---------------------------------------------------------------
# Every event arrives as an order in raw JSON, by day; purchases arrive a
# second time a day later. Orders of type error have no customer, amounts are
# lowered by 5 so that some are not positive, and views carry no amount.


def _bronze_rows(spark, sf):
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    # element_at takes the last of elements that are never NULL for a NULL position
    region = F.when(
        F.col("user_id").isNotNull(), F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col("user_id") % 4 + 1).cast("int"))
    )
    payload = F.to_json(
        F.struct(
            F.col("event_id").alias("order_id"),
            F.when(kind != "error", F.concat(F.lit("C"), "user_id")).alias("customer_id"),
            F.when(kind != "view", F.col("value") - 5).alias("amount"),
            region.alias("region"),
            F.when(kind.isin("purchase", "click"), "completed").otherwise("pending").alias("status"),
            F.date_format("ts", "yyyy-MM-dd").alias("order_date"),
        ),
        {"ignoreNullFields": "false"},
    )

    def delivered(rows, days_late):
        day = F.date_add(F.col("ts").cast("date"), days_late)
        return rows.select(
            day.cast("timestamp").alias("ingestion_timestamp"),
            F.concat(F.lit("orders_"), F.date_format(day, "yyyyMMdd"), F.lit(".json")).alias("source_file"),
            payload.alias("raw_payload"),
        )

    return delivered(events, 0), delivered(events.where(kind == "purchase"), 1)


_PARSED_SQL = """
    WITH first_time AS (
        SELECT event_id::INTEGER AS order_id, CASE WHEN event_type != 'error' THEN 'C' || user_id END AS customer_id,
               CASE WHEN event_type != 'view' THEN value - 5 END AS amount,
               (['North', 'South', 'East', 'West'])[user_id % 4 + 1] AS region,
               CASE WHEN event_type IN ('purchase', 'click') THEN 'completed' ELSE 'pending' END AS status,
               ts::DATE AS order_date, event_type FROM events),
    parsed AS (
        SELECT *, 'orders_' || strftime(order_date, '%Y%m%d') || '.json' AS source_file FROM first_time
        UNION ALL
        SELECT *, 'orders_' || strftime(order_date + 1, '%Y%m%d') || '.json' FROM first_time
        WHERE event_type = 'purchase'),
    valid AS (SELECT * FROM parsed WHERE customer_id IS NOT NULL AND amount > 0),
    quarantine AS (SELECT * FROM parsed WHERE NOT COALESCE(customer_id IS NOT NULL AND amount > 0, false)),
    silver AS (SELECT order_id, customer_id, amount, region, status, order_date, MIN(source_file) AS source_file
               FROM valid GROUP BY ALL)
"""
_SILVER_COLUMNS = ["order_id", "customer_id", "amount", "region", "status", "order_date", "source_file"]


def _bronze(spark, sf):
    on_time, again = _bronze_rows(spark, sf)
    return on_time.unionByName(again)


def _layers(spark, sf):
    layers = open_layers(spark, new_path(spark, "layers"))
    for batch in _bronze_rows(spark, sf):
        layers.bronze.append(batch)
    refresh(layers)
    return layers


@query("bronze_counts", _PARSED_SQL + """
    SELECT source_file, COUNT(*) AS row_count FROM parsed GROUP BY source_file""")
def bronze_counts(spark, sf):
    layers = open_layers(spark, new_path(spark, "layers"))
    for batch in _bronze_rows(spark, sf):
        layers.bronze.append(batch)
    return layers.bronze.read().groupBy("source_file").agg(F.count("*").alias("row_count"))


@query("bronze_parsed", _PARSED_SQL + """
    SELECT order_id, customer_id, amount, region, status, order_date, source_file FROM parsed""")
def bronze_parsed(spark, sf):
    return parse_bronze(_bronze(spark, sf)).select(*_SILVER_COLUMNS)


@query("silver_valid", _PARSED_SQL + "SELECT order_id, customer_id, amount, source_file FROM valid")
def silver_valid(spark, sf):
    valid, _ = split_orders(parse_bronze(_bronze(spark, sf)))
    return valid.select("order_id", "customer_id", "amount", "source_file")


@query("quarantine", _PARSED_SQL + "SELECT order_id, customer_id, amount, region, status FROM quarantine")
def quarantine(spark, sf):
    return _layers(spark, sf).quarantine.read().select("order_id", "customer_id", "amount", "region", "status")


@query("silver_orders", _PARSED_SQL + "SELECT * FROM silver")
def silver_orders(spark, sf):
    layers = _layers(spark, sf)
    refresh(layers)  # a second run adds nothing
    return layers.silver.read().select(*_SILVER_COLUMNS)


@query("gold_revenue", _PARSED_SQL + """
    SELECT region, order_date, COUNT(order_id) AS order_count, ROUND(SUM(amount), 2) AS total_revenue,
           ROUND(AVG(amount), 9) AS avg_order_value, MAX(amount) AS max_order_value
    FROM silver WHERE status = 'completed' GROUP BY region, order_date""")
def gold_revenue(spark, sf):
    return _layers(spark, sf).gold.read().select(
        "region", "order_date", "order_count", F.round("total_revenue", 2).alias("total_revenue"),
        F.round("avg_order_value", 9).alias("avg_order_value"), "max_order_value",
    )


@query("gold_after_changes", _PARSED_SQL + """
    , changed AS (SELECT order_id, CASE WHEN region = 'North' AND amount > 60 THEN 'South' ELSE region END AS region,
                         CASE WHEN region = 'East' THEN amount + 1 ELSE amount END AS amount, status, order_date
                  FROM silver WHERE NOT COALESCE(region = 'West' AND amount > 80, false))
    SELECT region, order_date, COUNT(order_id) AS order_count, ROUND(SUM(amount), 2) AS total_revenue,
           ROUND(AVG(amount), 6) AS avg_order_value, MAX(amount) AS max_order_value
    FROM changed WHERE status = 'completed' GROUP BY region, order_date""")
def gold_after_changes(spark, sf):
    """Gold follows orders that move, change their amount or go, from the changes alone."""
    layers = _layers(spark, sf)
    layers.silver.update("region = 'North' AND amount > 60", {"region": "'South'"})
    layers.silver.update("region = 'East'", {"amount": "amount + 1"})
    layers.silver.delete("region = 'West' AND amount > 80")
    refresh(layers)
    return layers.gold.read().select(
        "region", "order_date", "order_count", F.round("total_revenue", 2).alias("total_revenue"),
        F.round("avg_order_value", 6).alias("avg_order_value"), "max_order_value",
    )


@query("medallion_counts", _PARSED_SQL + """
    SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM parsed UNION ALL SELECT 'silver', COUNT(*) FROM silver
    UNION ALL SELECT 'quarantine', COUNT(*) FROM quarantine UNION ALL SELECT 'repeated in silver', 0
    UNION ALL SELECT 'gold', COUNT(DISTINCT (region, order_date)) FROM silver WHERE status = 'completed'""")
def medallion_counts(spark, sf):
    layers = _layers(spark, sf)
    return layer_counts({
        "bronze": layers.bronze.read(),
        "silver": layers.silver.read(),
        "quarantine": layers.quarantine.read(),
        "repeated in silver": duplicate_keys(layers.silver.read(), ["order_id"]),
        "gold": layers.gold.read(),
    })


# ---- incremental loads ----------------------------------------------------------------------


def _loads(spark, sf):
    """A run for each of two early periods, one for all the rest, and one without news."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    sink = VersionedRows.create(spark, new_path(spark, "loaded"), events.schema)
    undated = VersionedRows.create(spark, new_path(spark, "undated"), events.schema)
    control = control_table(spark, new_path(spark, "control"), "events", "1000-01-01 00:00:00")
    counts = []
    for until in ["2024-01-11", "2024-01-21", None, None]:
        arrived = events
        if until:
            arrived = events.where(F.col("ts").isNull() | (F.col("ts") < F.lit(until).cast("timestamp_ntz")))
        counts.append(incremental_load(arrived, sink, control, "events", "event_id", "ts", undated))
    return sink, control, counts, undated


@query("incremental_first", "SELECT event_id, user_id, value, ts FROM events WHERE ts < TIMESTAMP '2024-01-11'")
def incremental_first(spark, sf):
    sink, *_ = _loads(spark, sf)
    return sink.read(version=1)


@query("incremental_batch", """
    SELECT event_id, user_id, value, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'""")
def incremental_batch(spark, sf):
    """The rows that only the second run added."""
    sink, *_ = _loads(spark, sf)
    _, added = sink.differing_rows(1, 2)
    return added


@query("incremental_total", """
    SELECT COUNT(*) AS row_count, COUNT(DISTINCT event_id) AS ids, ROUND(SUM(value), 2) AS total, 3::BIGINT AS versions,
           (SELECT COUNT(*) FROM events WHERE ts IS NULL) AS undated
    FROM events WHERE ts IS NOT NULL""")
def incremental_total(spark, sf):
    sink, _, _, undated = _loads(spark, sf)
    return sink.read().agg(
        F.count("*").alias("row_count"), F.count_distinct("event_id").alias("ids"),
        F.round(F.sum("value"), 2).alias("total"), F.lit(sink.current_version()).cast("long").alias("versions"),
        F.lit(undated.read().count()).cast("long").alias("undated"),
    )


@query("watermark_state", """
    SELECT 'events' AS table_name, MAX(ts) AS last_processed_timestamp,
           COUNT(*) FILTER (ts < TIMESTAMP '2024-01-11') AS run_1,
           COUNT(*) FILTER (ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21') AS run_2,
           COUNT(*) FILTER (ts >= TIMESTAMP '2024-01-21') AS run_3, 0::BIGINT AS run_4 FROM events""")
def watermark_state(spark, sf):
    _, control, counts, _ = _loads(spark, sf)
    return control.read().select(
        "table_name", F.col("last_processed_timestamp").cast("timestamp_ntz").alias("last_processed_timestamp"),
        *[F.lit(n).cast("long").alias(f"run_{i + 1}") for i, n in enumerate(counts)],
    )


# ---- summaries of one enriched base ------------------------------------------------------------


def _summaries(spark, sf):
    """Orders above 1500 with their customer's nation: by priority, by nation and name, by status."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_key")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    facts = orders.select("o_orderpriority", "o_orderstatus", "o_totalprice", "nation_key")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation_key"), "n_name")
    return fanout(
        facts, nations, "nation_key", F.col("o_totalprice") > 1500,
        {"dept": ["o_orderpriority"], "region": ["nation_key", "n_name"], "status": ["o_orderstatus"]},
        [
            F.count("*").alias("txn_count"),
            F.round(F.avg("o_totalprice"), 2).alias("avg_amount"),
            F.round(F.sum("o_totalprice"), 2).alias("total_amount"),
        ],
        new_path(spark, "summaries"),
    )


_BASE_SQL = """
    WITH base AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 1500)
"""


@query("fanout_dept", _BASE_SQL + """
    SELECT o_orderpriority, COUNT(*) AS txn_count, ROUND(AVG(o_totalprice), 2) AS avg_amount
    FROM base GROUP BY o_orderpriority""")
def fanout_dept(spark, sf):
    written, _ = _summaries(spark, sf)
    return written["dept"].select("o_orderpriority", "txn_count", "avg_amount")


@query("fanout_region", _BASE_SQL + """
    SELECT n_nationkey AS nation_key, n_name, ROUND(SUM(o_totalprice), 2) AS total_amount
    FROM base GROUP BY n_nationkey, n_name""")
def fanout_region(spark, sf):
    written, _ = _summaries(spark, sf)
    return written["region"].select("nation_key", "n_name", "total_amount")


@query("fanout_status", _BASE_SQL + """
    SELECT o_orderstatus, COUNT(*) AS txn_count,
           (SELECT COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE NOT COALESCE(o_totalprice > 1500, false)) AS bad_records
    FROM base GROUP BY o_orderstatus""")
def fanout_status(spark, sf):
    written, bad = _summaries(spark, sf)
    return written["status"].select("o_orderstatus", "txn_count", F.lit(bad).cast("long").alias("bad_records"))
