"""Column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.functions.scalars import band, json_field, lookup, lookup_udf, parse_amount, parse_date, parse_timestamp
from millpond.queries.registry import query, table
from millpond.sources.generated import DEPARTMENTS, REGIONS, STATUSES, synthetic_transactions

# fixed values: the conversion rate and the salary bands
GBP_RATE = 0.79
SENIOR_FROM, MID_FROM = 100_000, 80_000

# fixed values: department to division
DIVISIONS = {
    "Engineering": "Technology",
    "Marketing": "Commercial",
    "HR": "Operations",
    "Finance": "Operations",
    "Sales": "Commercial",
}

# market segments of the given tables, in the same role; BUILDING is left out to show the default
SEGMENT_DIVISIONS = {
    "MACHINERY": "Technology",
    "AUTOMOBILE": "Technology",
    "FURNITURE": "Commercial",
    "HOUSEHOLD": "Commercial",
}


@query("derived_column", """
    SELECT c_custkey, c_acctbal, ROUND(c_acctbal * 0.79::DOUBLE, 2) AS balance_gbp,
           c_custkey * 2 AS doubled FROM customer""")
def derived_column(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return customer.withColumn("balance_gbp", F.round(F.col("c_acctbal") * GBP_RATE, 2)).withColumn(
        "doubled", F.col("c_custkey") * 2
    )


@query("case_band", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice >= 100000 THEN 'Senior'
        WHEN o_totalprice >= 80000 THEN 'Mid' ELSE 'Junior' END AS band FROM orders""")
def case_band(spark, sf):
    bands = [(SENIOR_FROM, "Senior"), (MID_FROM, "Mid")]
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", band(F.col("o_totalprice"), bands, "Junior").alias("band")
    )


@query("clean_number", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS amount FROM orders""")
def clean_number(spark, sf):
    written = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.format_number("o_totalprice", 2))
    return table(spark, sf, "orders").select("o_orderkey", parse_amount(written).alias("amount"))


@query("parse_date", """
    SELECT o_orderkey, o_orderdate::DATE AS day_first, o_orderdate::DATE AS iso,
           try_strptime(strftime(o_orderdate, '%m/%d/%Y'), '%d/%m/%Y')::DATE AS misread FROM orders""")
def parse_date_query(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        parse_date(F.date_format(day, "dd/MM/yyyy"), "dd/MM/yyyy").alias("day_first"),
        parse_date(F.date_format(day, "yyyy-MM-dd"), "yyyy-MM-dd").alias("iso"),
        parse_date(F.date_format(day, "MM/dd/yyyy"), "dd/MM/yyyy").alias("misread"),
    )


@query("parse_timestamp", """
    SELECT event_id, date_trunc('second', ts) AS at,
           CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS checked FROM events""")
def parse_timestamp_query(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), text)).otherwise(text)
    return table(spark, sf, "events").select(
        "event_id",
        parse_timestamp(text).cast("timestamp_ntz").alias("at"),
        parse_timestamp(broken).cast("timestamp_ntz").alias("checked"),
    )


@query("json_extract", """
    SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k,
           json_extract_string(props, '$.k') AS k_text, NULL::VARCHAR AS missing FROM events""")
def json_extract(spark, sf):
    props = F.col("props")
    return table(spark, sf, "events").select(
        "event_id",
        json_field(props, "$.k", "int").alias("k"),
        json_field(props, "$.k").alias("k_text"),
        json_field(props, "$.absent").alias("missing"),
    )


_LOOKUP_SQL = """
    SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Technology'
        WHEN 'AUTOMOBILE' THEN 'Technology' WHEN 'FURNITURE' THEN 'Commercial'
        WHEN 'HOUSEHOLD' THEN 'Commercial' ELSE 'Unknown' END AS division FROM customer"""


@query("map_lookup", _LOOKUP_SQL)
def map_lookup(spark, sf):
    division = lookup(F.col("c_mktsegment"), SEGMENT_DIVISIONS, "Unknown")
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", division.alias("division"))


@query("map_lookup_udf", _LOOKUP_SQL)
def map_lookup_udf(spark, sf):
    division = lookup_udf(spark.sparkContext.broadcast(SEGMENT_DIVISIONS), "Unknown")
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", division("c_mktsegment").alias("division"))


def _draw_sql(seed: int, stream: int, size: int) -> str:
    mixed = f"(((o_orderkey % 1000003) * {7919 + 2 * stream} + {seed * 104729 + stream * 15485863}) % 1000003)"
    return f"(({mixed} * 31) % {size})"


def _choice_sql(seed: int, stream: int, values: list[str]) -> str:
    return f"(list_value({', '.join(repr(v) for v in values)}))[({_draw_sql(seed, stream, len(values))} + 1)::INT]"


_TRANSACTIONS_SQL = f"""
    SELECT o_orderkey AS txn_id, 'EMP-' || ({_draw_sql(42, 1, 100)} + 1) AS emp_id,
           {_choice_sql(42, 2, DEPARTMENTS)} AS dept, {_choice_sql(42, 3, REGIONS)} AS region,
           {_choice_sql(42, 4, STATUSES)} AS status, {_draw_sql(42, 5, 9901)} + 100 AS amount,
           0.5::DOUBLE + {_draw_sql(42, 6, 4501)} / 1000::DOUBLE AS exchange_rate FROM orders"""


@query("synth_transactions", _TRANSACTIONS_SQL)
def synth_transactions(spark, sf):
    return synthetic_transactions(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("synth_divisions", f"""
    SELECT DISTINCT dept, CASE dept WHEN 'Engineering' THEN 'Technology' WHEN 'Marketing' THEN 'Commercial'
        WHEN 'HR' THEN 'Operations' WHEN 'Finance' THEN 'Operations' WHEN 'Sales' THEN 'Commercial'
        ELSE 'Unknown' END AS division FROM ({_TRANSACTIONS_SQL}) ORDER BY dept""")
def synth_divisions(spark, sf):
    made = synthetic_transactions(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    pairs = made.withColumn("division", lookup(F.col("dept"), DIVISIONS, "Unknown")).select("dept", "division")
    return pairs.distinct().orderBy("dept")
