"""Reading and writing files: known answers, error modes and layouts."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import fixtures as fx
from conftest import plan, rows
from millpond.functions.scalars import parse_amount, parse_date
from millpond.operators.layout import layout_report
from millpond.sources import files, sinks
from millpond.workspace import staged, work_root

SF = "/root/testdata/sf0.001"


def put(root, name, lines):
    path = f"{root}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(lines))
    return path


def data_files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_clean_delimited_file(spark, root):
    path = put(root, "staff.csv", fx.STAFF_CSV)
    schema = "emp_id string, name string, salary long, hire_date string, bonus string"
    raw = files.read_csv(spark, path, schema, sep="|", null_value="N/A")
    clean = raw.select("emp_id", parse_amount(F.col("bonus")).alias("bonus"),
                       parse_date(F.col("hire_date"), "dd/MM/yyyy").cast("string").alias("hired"))
    found = rows(clean, "emp_id")
    assert [r[1] for r in found] == [12500.0, None, 18750.0, None, 11000.0, None]
    assert found[0][2] == "2019-03-15" and all(r[2] for r in found)


def test_inferred_types_of_a_dirty_file(spark, root):
    read = files.read_csv(spark, put(root, "staff.csv", fx.STAFF_CSV), sep="|", null_value="N/A")
    assert dict(read.dtypes)["salary"] == "int"
    assert dict(read.dtypes)["bonus"] == "string" and dict(read.dtypes)["hire_date"] == "string"


@pytest.fixture
def landing(root):
    put(root, "landing/day1.csv", fx.LANDING_DAY_1)
    put(root, "landing/day2.csv", fx.LANDING_DAY_2)
    return f"{root}/landing"


def test_permissive_split(spark, landing):
    clean, corrupt = files.read_csv_split(spark, landing, fx.LANDING_SCHEMA, null_value="NULL")
    assert clean.count() == 2 and corrupt.count() == 3
    assert [r[0] for r in rows(clean.select("order_id"), "order_id")] == [101, 102]
    assert sorted(r[0].split(",")[0] for r in corrupt.collect()) == ["103", "104", "105"]


def test_dropmalformed_counts_what_it_returns(spark, landing):
    kept = files.read_csv(spark, landing, fx.LANDING_SCHEMA, mode="DROPMALFORMED")
    assert kept.count() == len(kept.collect()) == kept.select("status").count() == 2


def test_failfast_raises_on_the_bad_row(spark, landing):
    with pytest.raises(Exception, match="Malformed records are detected"):
        files.read_csv(spark, f"{landing}/day1.csv", fx.LANDING_SCHEMA, mode="FAILFAST")
    good = files.read_csv(spark, f"{landing}/day1.csv", "a string, b string, c string, d string, e string", mode="FAILFAST")
    assert good.count() == 3


def test_landing_listing(spark, landing):
    listed = files.list_landing(spark, landing)
    assert [r[0] for r in rows(listed.select("name"), "name")] == ["day1.csv", "day2.csv"]
    assert listed.first().size > 100
    assert files.list_landing(spark, landing, "day2*").count() == 1


def test_json_directory_and_glob(spark, root):
    for day, ids in {"15": [2001, 2002], "16": [2003, 2004], "17": [2005]}.items():
        put(root, f"daily/orders_2024-01-{day}.json", [f'{{"order_id": {i}, "amount": 1.5}}' for i in ids])
    assert files.read_json(spark, f"{root}/daily").count() == 5
    two = files.read_json(spark, f"{root}/daily/orders_2024-01-1[56].json", "order_id int, amount double")
    assert sorted(r.order_id for r in two.collect()) == [2001, 2002, 2003, 2004]


def test_nullability_is_not_enforced_by_file_reads(spark, root):
    path = put(root, "x.json", ['{"b": 1}'])
    read = files.read_json(spark, path, "a int NOT NULL, b int")
    assert rows(read) == [(None, 1)]


def test_partition_pruning_reads_one_folder(spark, root):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    sinks.write_parquet(orders, f"{root}/by-status", partition_by="o_orderstatus")
    kept = spark.read.parquet(f"{root}/by-status").filter("o_orderstatus = 'F'")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan(kept)
    assert {f.split("o_orderstatus=")[1][0] for f in kept.inputFiles()} >= {"F"}
    assert kept.count() == orders.filter("o_orderstatus = 'F'").count()
    for status in "FOP":
        assert len(data_files(f"{root}/by-status/o_orderstatus={status}")) <= 4


def test_one_file_report_and_sized_write(spark, root):
    df = spark.range(1000).repartition(6)
    sinks.write_csv(df, f"{root}/csv", one_file=True)
    assert len(data_files(f"{root}/csv")) == 1
    sinks.write_sized(df, f"{root}/sized", total_bytes=300 * 1024 * 1024)
    assert len(data_files(f"{root}/sized")) == 3
    assert spark.read.parquet(f"{root}/sized").count() == 1000


def test_layout_report(spark, root):
    df = spark.range(5000).selectExpr("id", "'some repeated text' AS t")
    sinks.write_parquet(df.repartition(3), f"{root}/p")
    sinks.write_csv(df.coalesce(1), f"{root}/c")
    report = layout_report({
        "parquet": spark.read.parquet(f"{root}/p"), "csv": files.read_csv(spark, f"{root}/c", "id long, t string"),
    })
    found = {r.output: r for r in report.collect()}
    assert found["parquet"].files == 3 and found["csv"].files == 1
    assert found["parquet"].rows == found["csv"].rows == 5000
    size = sum(os.path.getsize(f"{root}/p/{f}") for f in data_files(f"{root}/p"))
    assert found["parquet"].bytes == size < found["csv"].bytes


def test_managed_and_external_tables(spark, root):
    spark.sql(f"CREATE DATABASE shelf LOCATION '{root}/shelf'")
    df = spark.range(3)
    sinks.save_managed(df, "shelf.managed")
    sinks.write_parquet(df, f"{root}/outside")
    sinks.register_external(spark, "shelf.external", f"{root}/outside")
    assert spark.table("shelf.managed").count() == spark.table("shelf.external").count() == 3
    sinks.drop_if_exists(spark, "shelf.managed", "shelf.external", "shelf.never")
    assert not os.path.exists(f"{root}/shelf/managed")
    assert spark.read.parquet(f"{root}/outside").count() == 3
    sinks.register_external(spark, "shelf.external", f"{root}/outside")
    assert spark.table("shelf.external").count() == 3
    with pytest.raises(PySparkException):
        spark.table("shelf.managed").count()
    sinks.drop_if_exists(spark, "shelf.external")


def test_staged_rows_come_from_the_shared_folder(spark):
    kept = staged(spark.range(5), "check")
    assert kept.count() == 5
    assert work_root(spark) in kept.inputFiles()[0]


def test_work_root_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_root(Session)
