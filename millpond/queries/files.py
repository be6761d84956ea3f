"""Writing and reading files and catalog tables; all rows come from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.functions.scalars import parse_amount, parse_date
from millpond.operators.layout import layout_report, spread_by
from millpond.operators.snapshot import SnapshotTable
from millpond.queries.registry import fresh_database, query, table, view
from millpond.sources import files, sinks
from millpond.streaming.landing import read_taken, take_landed
from millpond.workspace import new_path, staged

ORDER_ROW = "order_id long, customer_id long, status string, amount double, order_date string, priority string"


def _order_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


_ORDER_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS amount,
           {date} AS order_date, {priority} AS priority FROM orders"""


# ---- delimited text -----------------------------------------------------------


@query("csv_explicit", _ORDER_SQL.format(
    date="o_orderdate::DATE", priority="CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderpriority END"))
def csv_explicit(spark, sf):
    path = new_path(spark, "orders-csv")
    low = F.col("priority") == "5-LOW"
    rows = _order_rows(spark, sf).withColumn("priority", F.when(low, "N/A").otherwise(F.col("priority")))
    sinks.write_csv(rows, path, sep="|")
    read = files.read_csv(spark, path, ORDER_ROW, sep="|", null_value="N/A")
    return read.withColumn("order_date", parse_date(F.col("order_date"), "yyyy-MM-dd"))


@query("csv_inferred", _ORDER_SQL.format(
    date="o_orderdate::DATE", priority="CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderpriority END"))
def csv_inferred(spark, sf):
    path = new_path(spark, "orders-csv")
    low = F.col("priority") == "5-LOW"
    rows = _order_rows(spark, sf).withColumn("priority", F.when(low, "N/A").otherwise(F.col("priority")))
    sinks.write_csv(rows, path, sep="|")
    read = files.read_csv(spark, path, sep="|", null_value="N/A")
    # which integer width is inferred depends on the values
    return read.select(
        F.col("order_id").cast("long"), F.col("customer_id").cast("long"), "status", "amount", "order_date", "priority"
    )


@query("clean_csv", """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS amount,
           o_orderdate::DATE AS order_date FROM orders""")
def clean_csv(spark, sf):
    path = new_path(spark, "raw-csv")
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(~F.col("o_orderstatus").eqNullSafe("P"), F.format_number("o_totalprice", 2)).alias("amount_text"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date_text"),
    )
    sinks.write_csv(raw, path, sep="|", nullValue="N/A")
    read = files.read_csv(
        spark, path, "order_id long, amount_text string, date_text string", sep="|", null_value="N/A"
    )
    return (
        read.withColumn("amount", parse_amount(F.col("amount_text")))
        .withColumn("order_date", parse_date(F.col("date_text"), "dd/MM/yyyy"))
        .drop("amount_text", "date_text")
    )


EVENT_LINE = "event_id long, user_id long, value double, day date, event_type string"


def _event_lines(spark, sf):
    """One text line per event; errors hold no number, signups have a field too many."""
    value = F.when(F.col("event_type") == "error", "INVALID").otherwise(F.col("value").cast("string"))
    extra = F.when(F.col("event_type") == "signup", "SAVE10")
    day = F.date_format("ts", "yyyy-MM-dd")
    # concat_ws skips NULLs, which would shift the columns: only the additional field may be left out
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (F.col("event_id"), F.col("user_id"), value, day, F.col("event_type"))]
    line = F.concat_ws(",", *fields, extra)
    path = new_path(spark, "event-lines")
    table(spark, sf, "events").select(line.alias("line")).write.text(path)
    return path


_LINE_SQL = """COALESCE(event_id::VARCHAR, '') || ',' || COALESCE(user_id::VARCHAR, '') || ','
    || CASE event_type WHEN 'error' THEN 'INVALID' ELSE COALESCE(value::VARCHAR, '') END || ','
    || COALESCE(strftime(ts, '%Y-%m-%d'), '') || ',' || COALESCE(event_type, '')
    || CASE event_type WHEN 'signup' THEN ',SAVE10' ELSE '' END"""
# an event without a type is neither an error nor a signup
_FITS_SQL = "COALESCE(event_type NOT IN ('error', 'signup'), true)"


@query("csv_permissive_split", f"""
    SELECT 'clean' AS part, event_id, user_id, value, ts::DATE AS day, event_type, NULL::VARCHAR AS raw
    FROM events WHERE {_FITS_SQL}
    UNION ALL SELECT 'corrupt', NULL, NULL, NULL, NULL, NULL, {_LINE_SQL}
    FROM events WHERE event_type IN ('error', 'signup')""")
def csv_permissive_split(spark, sf):
    clean, corrupt = files.read_csv_split(spark, _event_lines(spark, sf), EVENT_LINE, header=False)
    return clean.select(F.lit("clean").alias("part"), "*").unionByName(
        corrupt.select(F.lit("corrupt").alias("part"), F.col(files.CORRUPT).alias("raw")), allowMissingColumns=True
    )


@query("csv_dropmalformed", f"SELECT event_id, value FROM events WHERE {_FITS_SQL}")
def csv_dropmalformed(spark, sf):
    lines = _event_lines(spark, sf)
    return files.read_csv(spark, lines, EVENT_LINE, header=False, mode="DROPMALFORMED").select("event_id", "value")


@query("csv_failfast", f"""
    SELECT event_id, user_id, value, ts::DATE AS day, event_type FROM events WHERE {_FITS_SQL}""")
def csv_failfast(spark, sf):
    """Rows that passed a quarantine step are read again with no tolerance for bad ones."""
    clean, _ = files.read_csv_split(spark, _event_lines(spark, sf), EVENT_LINE, header=False)
    path = new_path(spark, "clean-events")
    sinks.write_csv(clean, path)
    return files.read_csv(spark, path, EVENT_LINE, mode="FAILFAST")


@query("landing_stream", f"""
    SELECT 'clean' AS part, event_id, user_id, value, ts::DATE AS day, event_type, NULL::VARCHAR AS raw
    FROM events WHERE {_FITS_SQL}
    UNION ALL SELECT 'corrupt', NULL, NULL, NULL, NULL, NULL, {_LINE_SQL}
    FROM events WHERE event_type IN ('error', 'signup')""")
def landing_stream(spark, sf):
    """Files are taken once each: a run over the first half, one after late files, and one without news."""
    landing, taken, checkpoint = (new_path(spark, name) for name in ("landing", "taken", "landing-checkpoint"))
    lines = spark.read.text(_event_lines(spark, sf))
    half = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for arrived in (lines.where(half), lines.where(~half), None):
        if arrived is not None:
            arrived.write.mode("append").text(landing)
        take_landed(spark, landing, taken, checkpoint, EVENT_LINE)
    clean, corrupt = read_taken(spark, taken, EVENT_LINE)
    return clean.select(F.lit("clean").alias("part"), *[c for c in clean.columns if c != "_file"]).unionByName(
        corrupt.select(F.lit("corrupt").alias("part"), F.col(files.CORRUPT).alias("raw")), allowMissingColumns=True
    )


@query("csv_roundtrip", """
    SELECT c_nationkey AS nation_key, COUNT(*) AS customers, ROUND(SUM(c_acctbal), 2) AS balance
    FROM customer GROUP BY c_nationkey""")
def csv_roundtrip(spark, sf):
    """A report of one row per nation, as one file with a header."""
    path = new_path(spark, "report-csv")
    report = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation_key")).agg(
        F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    sinks.write_csv(report, path, one_file=True)
    return files.read_csv(spark, path, "nation_key int, customers long, balance double")


# ---- JSON lines -------------------------------------------------------------------


@query("json_explicit", _ORDER_SQL.format(date="o_orderdate::DATE", priority="o_orderpriority"))
def json_explicit(spark, sf):
    path = new_path(spark, "orders-json")
    sinks.write_json(_order_rows(spark, sf), path)
    read = files.read_json(spark, path, ORDER_ROW)
    return read.withColumn("order_date", parse_date(F.col("order_date"), "yyyy-MM-dd"))


def _daily_events(spark, sf):
    path = new_path(spark, "daily-events")
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "value", "event_type", F.col("ts").cast("date").alias("day")
    )
    sinks.write_json(rows, path, partition_by="day")
    return path


@query("json_directory", "SELECT event_id, user_id, value, event_type, ts::DATE AS day FROM events")
def json_directory(spark, sf):
    return files.read_json(spark, _daily_events(spark, sf)).select(
        "event_id", "user_id", "value", "event_type", F.col("day").cast("date")
    )


@query("json_glob", """
    SELECT event_id, value, event_type FROM events WHERE ts::DATE IN (DATE '2024-01-15', DATE '2024-01-16')""")
def json_glob(spark, sf):
    return files.read_json(spark, f"{_daily_events(spark, sf)}/day=2024-01-1[56]").select(
        "event_id", "value", "event_type"
    )


@query("list_landing", f"""
    SELECT ts::DATE AS day, SUM(octet_length(encode({_LINE_SQL})) + 1)::BIGINT AS bytes FROM events GROUP BY 1""")
def list_landing(spark, sf):
    """Bytes that landed per day, from the listing alone; lines without a day have a folder of their own."""
    path = new_path(spark, "landing")
    lines = spark.read.text(_event_lines(spark, sf))
    by_day = lines.withColumn("day", F.regexp_extract("value", r"(\d{4}-\d\d-\d\d)", 1))
    spread_by(by_day, "day").write.partitionBy("day").text(path)
    return (
        files.list_landing(spark, path, "*.txt")
        .groupBy(F.regexp_extract("path", "day=([^/]+)/", 1).try_cast("date").alias("day"))
        .agg(F.sum("size").alias("bytes"))
    )


# ---- Parquet and catalog tables --------------------------------------------------------


@query("parquet_roundtrip", "SELECT * FROM part")
def parquet_roundtrip(spark, sf):
    path = new_path(spark, "part-parquet")
    sinks.write_parquet(table(spark, sf, "part"), path)
    return files.read_parquet(spark, path)


@query("partition_pruned_scan", """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def partition_pruned_scan(spark, sf):
    path = new_path(spark, "orders-by-status")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_parquet(rows, path, partition_by="o_orderstatus")
    return files.read_parquet(spark, path).filter(F.col("o_orderstatus") == "F")


@query("managed_table", "SELECT * FROM supplier")
def managed_table(spark, sf):
    name = f"{fresh_database(spark)}.supplier"
    sinks.drop_if_exists(spark, name)
    sinks.save_managed(table(spark, sf, "supplier"), name)
    return spark.table(name)


@query("catalog_table", """
    SELECT s_nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY s_nationkey""")
def catalog_table(spark, sf):
    name = f"{fresh_database(spark)}.supplier"
    half = table(spark, sf, "supplier")
    rich = F.coalesce(F.col("s_acctbal") >= 0, F.lit(False))
    sinks.save_managed(half.where(rich), name)
    sinks.save_managed(half.where(~rich), name, mode="append")
    return spark.sql(f"SELECT s_nationkey, COUNT(*) AS suppliers FROM {name} GROUP BY s_nationkey")


@query("external_table", "SELECT * FROM part WHERE p_size > 25")
def external_table(spark, sf):
    """Dropped and registered again: the rows of an external table stay."""
    database, path = fresh_database(spark), new_path(spark, "external-part")
    sinks.write_parquet(table(spark, sf, "part"), path)
    name = f"{database}.part"
    sinks.register_external(spark, name, path)
    sinks.drop_if_exists(spark, name)
    sinks.register_external(spark, name, path)
    return spark.table(name).where(F.col("p_size") > 25)


@query("ctas_filter", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'PROMO'")
def ctas_filter(spark, sf):
    view(spark, sf, "part")
    name = f"{fresh_database(spark)}.promo_parts"
    spark.sql(f"""
        CREATE TABLE {name} USING PARQUET AS
        SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'PROMO'""")
    return spark.table(name)


@query("ctas_aggregate", """
    SELECT p_type, COUNT(*) AS parts, ROUND(SUM(p_retailprice), 2) AS total_price FROM part GROUP BY p_type""")
def ctas_aggregate(spark, sf):
    view(spark, sf, "part")
    name = f"{fresh_database(spark)}.parts_by_type"
    spark.sql(f"""
        CREATE TABLE {name} USING PARQUET AS
        SELECT p_type, COUNT(*) AS parts, ROUND(SUM(p_retailprice), 2) AS total_price FROM part GROUP BY p_type""")
    return spark.table(name)


@query("sized_write", """
    SELECT COUNT(*) AS row_count, SUM(l_quantity)::DOUBLE AS quantity, GREATEST(CEIL(SUM(48
           + COALESCE(octet_length(encode(l_returnflag)), 0) + COALESCE(octet_length(encode(l_linestatus)), 0)) / 1048576), 1)::BIGINT
           AS files
    FROM (SELECT l_quantity, l_returnflag, l_linestatus FROM lineitem)""")
def sized_write(spark, sf):
    """Three columns of all line items in as many files of a megabyte as their measured size calls for."""
    path = new_path(spark, "sized")
    items = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_partkey", "l_returnflag", "l_linestatus")
    sinks.write_sized(items, path, file_bytes=1 << 20)
    return files.read_parquet(spark, path).withColumn("file", F.input_file_name()).agg(
        F.count("*").alias("row_count"), F.sum("l_quantity").cast("double").alias("quantity"),
        F.count_distinct("file").alias("files"),
    )


@query("layout_report", """
    SELECT unnest(['csv', 'parquet', 'versioned']) AS output, COUNT(*) AS rows,
           true AS has_files, unnest([false, true, true]) AS smaller_than_csv FROM lineitem""")
def layout_report_query(spark, sf):
    """The same rows as CSV, Parquet and a versioned table, compared by stored bytes."""
    items = table(spark, sf, "lineitem")
    csv, parquet = new_path(spark, "layout-csv"), new_path(spark, "layout-parquet")
    sinks.write_csv(items, csv)
    sinks.write_parquet(items, parquet)
    versioned = SnapshotTable.write(spark, new_path(spark, "layout-versioned"), items)
    report = staged(layout_report({
        "csv": files.read_csv(spark, csv, items.schema),
        "parquet": files.read_parquet(spark, parquet),
        "versioned": versioned.read(),
    }), "layout-report")
    csv_bytes = report.where(F.col("output") == "csv").first().bytes
    return report.select(
        "output", "rows", (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") < F.lit(csv_bytes)).alias("smaller_than_csv"),
    )
