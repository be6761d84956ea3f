"""MERGE and slowly changing dimensions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators.bucketed import merge_bucketed, write_bucketed
from millpond.operators.dedup import first_per_key
from millpond.operators.intervals import VersionedRows
from millpond.operators.joins import as_of_join
from millpond.operators.merge import WhenMatched, WhenNotMatched, merge_frames
from millpond.operators.scd import current_rows, open_history, scd2_apply, scd2_merge
from millpond.queries.registry import fresh_database, query, table
from millpond.workspace import new_path


# ---- MERGE with change codes --------------------------------------------------------
# The target holds orders before 2000, the source changes from 1997 on: urgent
# orders are deleted, high and medium ones updated, the rest inserted. Codes
# that do not fit (an insert of a known order, an update or delete of an
# unknown one) are ignored. Undated orders are in the target and never change;
# orders without a priority count as low.


def _target(orders):
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return orders.where(~F.coalesce(late, F.lit(False)))


def _changes(orders):
    code = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "D")
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "U")
        .otherwise("I")
    )
    late = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return late.select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderdate", "o_orderpriority", code.alias("op_type"),
    )


#: Buckets of the bucketed target; a table of terabytes has thousands.
BUCKETS = 16
MATCHED = [
    WhenMatched("s.op_type = 'D'", delete=True),
    WhenMatched("s.op_type = 'U'", {"o_totalprice": "s.o_totalprice", "o_orderstatus": "s.o_orderstatus"}),
]
NOT_MATCHED = [WhenNotMatched("s.op_type = 'I'")]

_CDC_SQL = """
    WITH known AS (SELECT *, CASE WHEN COALESCE(o_orderdate < TIMESTAMP '1997-01-01', true) THEN 'keep'
                       WHEN o_orderpriority = '1-URGENT' THEN 'delete'
                       WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'update' ELSE 'keep' END AS action
                   FROM orders WHERE NOT COALESCE(o_orderdate >= TIMESTAMP '2000-01-01', false)),
         unknown AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
                     AND COALESCE(o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), true))
"""


@query("merge_cdc", _CDC_SQL + """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM known
    WHERE action = 'keep'
    UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice + 1, o_orderdate, o_orderpriority FROM known
    WHERE action = 'update'
    UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice + 1, o_orderdate, o_orderpriority FROM unknown""")
def merge_cdc(spark, sf):
    orders = table(spark, sf, "orders")
    target = VersionedRows.write(spark, new_path(spark, "merge"), _target(orders))
    target.merge(_changes(orders), ["o_orderkey"], MATCHED, NOT_MATCHED)
    return target.read()


@query("merge_changes", _CDC_SQL + """
    SELECT 'delete' AS _change_type, o_orderkey, o_orderstatus, o_totalprice FROM known WHERE action = 'delete'
    UNION ALL SELECT 'update_preimage', o_orderkey, o_orderstatus, o_totalprice FROM known WHERE action = 'update'
    UNION ALL SELECT 'update_postimage', o_orderkey, 'X', o_totalprice + 1 FROM known WHERE action = 'update'
    UNION ALL SELECT 'insert', o_orderkey, 'X', o_totalprice + 1 FROM unknown""")
def merge_changes(spark, sf):
    """The change rows of the same merge, over DataFrames without a versioned table."""
    orders = table(spark, sf, "orders")
    _, changes = merge_frames(_target(orders), _changes(orders), ["o_orderkey"], MATCHED, NOT_MATCHED)
    return changes.select("_change_type", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("merge_buckets", _CDC_SQL + """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM known
    WHERE action = 'keep'
    UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice + 1, o_orderdate, o_orderpriority FROM known
    WHERE action = 'update'
    UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice + 1, o_orderdate, o_orderpriority FROM unknown""")
def merge_buckets(spark, sf):
    """The same merge into a bucketed table, of which only the source shuffles."""
    orders = table(spark, sf, "orders")
    name = f"{fresh_database(spark)}.orders"
    write_bucketed(_target(orders), name, ["o_orderkey"], BUCKETS)
    merge_bucketed(spark, name, _changes(orders), ["o_orderkey"], BUCKETS, MATCHED, NOT_MATCHED)
    return spark.table(name)


@query("merge_insert_only", "SELECT event_id, event_type, user_id, ts FROM events")
def merge_insert_only(spark, sf):
    """Late events delivered again, purchases twice: each is stored once."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    cut = lambda day: F.col("ts") >= F.lit(day).cast("timestamp_ntz")
    # undated events are stored, not late
    early = ~F.coalesce(cut("2024-01-16"), F.lit(False))
    stored = VersionedRows.write(spark, new_path(spark, "insert-only"), events.where(early))
    late = events.where(cut("2024-01-10"))
    delivered = late.unionByName(late.where(F.col("event_type") == "purchase"))
    once = first_per_key(delivered, ["event_id"], ["ts"])
    stored.merge(once, ["event_id"], not_matched=[WhenNotMatched(None, {
        "event_id": "s.event_id", "event_type": "s.event_type", "user_id": "s.user_id", "ts": "s.ts",
    })])
    return stored.read()


# ---- slowly changing dimension ----------------------------------------------------------
# All customers are current since 1995. On 1998-06-15 those in debt move to
# another segment; the others, also those without a balance, stay as they are.

MOVED_ON = "1998-06-15"


def _history(spark, sf):
    return open_history(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "1995-01-01"
    )


def _moves(spark, sf):
    """The latest state of every customer; only customers in debt really differ."""
    in_debt = F.col("c_acctbal") < 0
    return table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(in_debt, "COLLECTION").otherwise(F.col("c_mktsegment")).alias("c_mktsegment")
    )


_SCD_SQL = """
    WITH dim AS (
        SELECT c_custkey, c_name, c_mktsegment, DATE '1995-01-01' AS valid_from,
               CASE WHEN c_acctbal < 0 THEN DATE '1998-06-15' END AS valid_to,
               NOT COALESCE(c_acctbal < 0, false) AS is_current
        FROM customer
        UNION ALL SELECT c_custkey, c_name, 'COLLECTION', DATE '1998-06-15', NULL, true
        FROM customer WHERE c_acctbal < 0)
"""


@query("scd2_apply", _SCD_SQL + "SELECT * FROM dim")
def scd2_apply_query(spark, sf):
    return scd2_apply(_history(spark, sf), _moves(spark, sf), "c_custkey", ["c_mktsegment"], MOVED_ON)


@query("scd2_merge", _SCD_SQL + "SELECT * FROM dim")
def scd2_merge_query(spark, sf):
    dim = VersionedRows.write(spark, new_path(spark, "dim"), _history(spark, sf))
    scd2_merge(dim, _moves(spark, sf), "c_custkey", ["c_mktsegment"], MOVED_ON)
    return dim.read()


@query("scd2_current", _SCD_SQL + "SELECT c_custkey, c_name, c_mktsegment FROM dim WHERE is_current")
def scd2_current(spark, sf):
    return current_rows(scd2_apply_query(spark, sf)).select("c_custkey", "c_name", "c_mktsegment")


@query("scd2_point_in_time", _SCD_SQL + """
    SELECT o_orderkey, o_orderdate::DATE AS order_date, c_name, c_mktsegment FROM orders JOIN dim
    ON o_custkey = c_custkey AND o_orderdate::DATE >= valid_from
       AND o_orderdate::DATE < COALESCE(valid_to, DATE '9999-12-31')""")
def scd2_point_in_time(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    joined = as_of_join(orders, scd2_apply_query(spark, sf), "c_custkey", "order_date")
    return joined.select("o_orderkey", "order_date", "c_name", "c_mktsegment")
