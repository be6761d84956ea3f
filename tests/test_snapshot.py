"""Versioned tables: known stories, refused writes and invariants."""

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import fixtures as fx
from conftest import rows
from millpond.operators.diff import row_diff, version_diff, version_diff_full
from millpond.operators.snapshot import (
    FEED_PROPERTY, RETENTION_PROPERTY, ConstraintViolation, SchemaMismatch, SnapshotTable,
)
from millpond.plans.recovery import recover, totals

SF = "/root/testdata/sf0.001"


@pytest.fixture
def staff(spark, root):
    five = spark.createDataFrame(fx.EMPLOYEES[:5], fx.EMPLOYEES_SCHEMA).select("id", "name", "salary")
    return SnapshotTable.write(spark, f"{root}/staff", five, at="2024-01-01 00:00:00")


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_version_sequence(spark, staff):
    more = spark.createDataFrame([(11, "Kim", 1), (12, "Lee", 2)], "id int, name string, salary long")
    assert staff.append(more) == 1
    assert staff.update("name = 'Alice'", {"salary": "102000"}) == 2
    assert staff.delete("id = 12") == 3
    assert [staff.read(version=v).count() for v in range(4)] == [5, 7, 7, 6]
    assert rows(staff.read(version=2).where("id = 1").select("salary")) == [(102000,)]
    assert rows(staff.read(version=1).where("id = 1").select("salary")) == [(95000,)]
    assert staff.restore(0) == 4
    assert staff.read().count() == 5 and staff.read(version=3).count() == 6
    assert [r.operation for r in staff.history().orderBy("version").collect()] == [
        "CREATE TABLE AS SELECT", "APPEND", "UPDATE", "DELETE", "RESTORE",
    ]
    assert staff.current_version() == 4


def test_unknown_versions(staff):
    with pytest.raises(LookupError):
        staff.read(version=9)
    with pytest.raises(LookupError):
        staff.read(timestamp="2023-12-31 23:59:59")


def test_timestamp_travel(spark, staff):
    staff.delete("id = 1", at="2024-02-01 00:00:00")
    assert staff.read(timestamp="2024-01-31 23:59:59").count() == 5
    assert staff.read(timestamp="2024-02-01 00:00:00").count() == 4


def test_versions_in_sql_text(spark, staff):
    staff.update("id = 1", {"salary": "salary + 1"})
    staff.as_view("staff_now"), staff.as_view("staff_before", version=0)
    changed = spark.sql("""
        SELECT n.id, n.salary - b.salary AS raised FROM staff_now n JOIN staff_before b ON n.id = b.id
        WHERE n.salary != b.salary""")
    assert rows(changed) == [(1, 1)]


def test_a_version_is_committed_once(staff):
    now = staff.commit()
    staff.delete("id = 1")
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        staff._republish(now, "SET TBLPROPERTIES", {})


def test_update_and_delete_treat_null_as_false(spark, root):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id int, x int")
    made = SnapshotTable.write(spark, f"{root}/t", df)
    made.update("x > 5", {"x": "x * 10"})
    assert rows(made.read(), "id") == [(1, 5), (2, None), (3, 70)]
    made.delete("x < 50")
    assert rows(made.read(), "id") == [(2, None), (3, 70)]


def test_unknown_columns_are_refused(spark, staff):
    with pytest.raises(SchemaMismatch):
        staff.update("id = 1", {"salry": "0"})
    assert staff.current_version() == 0


def test_vacuum_of_an_empty_table(spark, root):
    made = SnapshotTable.create(spark, f"{root}/e", "id int")
    assert made.vacuum(retain_hours=0, force=True).count() == 0


def test_appended_rows(spark, staff):
    two = spark.createDataFrame([(11, "Kim", 1), (12, "Lee", 2)], "id int, name string, salary long")
    staff.append(two)
    staff.update("id < 3", {"salary": "0"})
    staff.append(two.limit(1))
    staff.optimize(cluster_by="id")
    assert staff.appended_rows(0, 4).count() == 8
    assert rows(staff.appended_rows(1, 4).select("id")) == [(11,)]
    assert staff.appended_rows(3, 4).count() == 0


def test_restore_over_an_added_column_is_in_the_feed(spark, root):
    made = SnapshotTable.create(spark, f"{root}/f", "id int, x int", {FEED_PROPERTY: "true"})
    made.append(spark.createDataFrame([(1, 1), (2, 2)], "id int, x int"))
    made.add_columns("note string")
    made.update("id = 1", {"note": "'n'"})
    made.restore(1)
    assert rows(made.read(), "id") == [(1, 1), (2, 2)]
    assert rows(made.changes(4).select("_change_type", "id")) == [("delete", 1), ("insert", 1)]


def test_nothing_to_change_makes_no_version(staff):
    assert staff.update("id = 99", {"salary": "0"}) == 0
    assert staff.delete("id = 99") == 0


def test_only_touched_files_are_rewritten(spark, root):
    df = spark.range(800).selectExpr("id", "id * 2 AS x").repartitionByRange(8, "id")
    made = SnapshotTable.write(spark, f"{root}/t", df)
    before = set(made.read().inputFiles())
    made.update("id = 5", {"x": "-1"})
    after = set(made.read().inputFiles())
    assert len(before) == 8 and len(before & after) == 7
    assert made.read().count() == 800 and rows(made.read().where("x < 0").select("id")) == [(5,)]
    made.delete("id >= 700")
    assert made.read().count() == 700
    old, new = made.differing_rows(0, made.current_version())
    assert 0 < old.count() < 400  # shared files are left out


def test_soft_delete(spark, root):
    made = SnapshotTable.write(spark, f"{root}/c", spark.createDataFrame(fx.CUSTOMERS, fx.CUSTOMERS_SCHEMA))
    made.add_columns("is_deleted boolean")
    made.update("is_deleted IS NULL", {"is_deleted": "false"})
    made.update("customer_id = 5", {"is_deleted": "true", "status": "'deleted'"})
    active = made.read().where("is_deleted = false OR is_deleted IS NULL")
    assert [r[0] for r in rows(active.select("customer_id"), "customer_id")] == [1, 2, 3, 4]
    assert made.read().count() == 5


def test_schema_is_enforced_then_evolved(spark, root):
    three = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id long, name string, price double")
    made = SnapshotTable.write(spark, f"{root}/p", three)
    wider = spark.createDataFrame([(4, "d", 4.0, "new")], "id long, name string, price double, category string")
    with pytest.raises(SchemaMismatch):
        made.append(wider)
    assert made.read().count() == 3 and made.current_version() == 0
    made.append(wider, merge_schema=True)
    assert rows(made.read().select("id", "category"), "id") == [(1, None), (2, None), (3, None), (4, "new")]
    made.add_columns("stock int, supplier string")
    assert [r.col_name for r in made.describe().collect()][-2:] == ["stock", "supplier"]
    made.append(spark.createDataFrame([(5, "e")], "id long, name string"))  # missing columns read as NULL
    assert rows(made.read().where("id = 5")) == [(5, "e", None, None, None, None)]
    with pytest.raises(SchemaMismatch):
        made.append(spark.createDataFrame([("x",)], "id string"))
    with pytest.raises(SchemaMismatch):
        made.add_columns("stock int")
    assert made.read(version=0).columns == ["id", "name", "price"]


def test_check_constraint(spark, root):
    made = SnapshotTable.create(spark, f"{root}/t", "txn_id int NOT NULL, amount double, status string")
    made.add_constraint("valid_amount", "amount > 0")
    good = spark.createDataFrame([(1, 10.0, "a"), (2, None, "b")], "txn_id int, amount double, status string")
    made.append(good)
    for bad in [(3, -5.0, "c"), (None, 5.0, "c")]:
        with pytest.raises(ConstraintViolation):
            made.append(spark.createDataFrame([(4, 1.0, "ok"), bad], good.schema))
    with pytest.raises(ConstraintViolation):
        made.update("txn_id = 1", {"amount": "amount - 100"})
    assert made.read().count() == 2 and made.current_version() == 2
    with pytest.raises(ConstraintViolation):
        made.add_constraint("small", "amount < 5")
    assert made.detail().first().constraints == {"valid_amount": "amount > 0"}


def test_properties_and_detail(spark, staff):
    staff.set_properties({RETENTION_PROPERTY: "2160"})
    staff.set_properties({"owner": "hr"})
    detail = staff.detail().first()
    assert detail.properties == {RETENTION_PROPERTY: "2160", "owner": "hr"}
    stored = [f for f in glob.glob(f"{staff.root}/data/*/part-*")]
    assert detail.num_files == len(stored) and detail.size_in_bytes == sum(map(os.path.getsize, stored))
    assert detail.version == 2 and detail.format == "parquet"


def test_empty_table(spark, root):
    made = SnapshotTable.create(spark, f"{root}/e", "id int, x string")
    assert made.read().count() == 0 and made.read().columns == ["id", "x"]
    assert made.detail().first().num_files == 0
    assert made.update("id = 1", {"x": "'a'"}) == 0
    assert made.optimize(cluster_by="id") == 0
    assert made.append(spark.createDataFrame([], "id int, x string"), skip_empty=True) == 0
    made.append(spark.createDataFrame([(1, "a")], "id int, x string"))
    made.delete("id = 1")
    assert made.read().count() == 0
    made.append(spark.createDataFrame([(2, "b")], "id int, x string"))
    assert rows(made.read()) == [(2, "b")]


def sales(spark, root, feed="false"):
    """Five rows, three more, then an update that spoils every amount."""
    made = SnapshotTable.create(spark, f"{root}/sales", "sale_id int, amount double", {FEED_PROPERTY: feed})
    made.append(spark.createDataFrame([(1, 999.99), (2, 699.99), (3, 499.99), (4, 199.99), (5, 289.99)], made.schema()))
    made.append(spark.createDataFrame([(6, 1099.99), (7, 799.99), (8, 299.99)], made.schema()))
    made.update("sale_id > 0", {"amount": "amount * 100"})
    return made


def total(df):
    return round(df.agg(F.sum("amount")).first()[0], 2)


def test_time_travel_totals_and_recovery(spark, root):
    made = sales(spark, root)
    assert [total(made.read(version=v)) for v in (1, 2, 3)] == [2689.95, 4889.92, 488992.0]
    spoiled = version_diff(made, 2, 3, "sale_id", "amount")
    assert spoiled.count() == 8 and spoiled.columns == ["sale_id", "current_amount", "previous_amount"]
    clone = made.clone(f"{root}/clone", version=2)
    assert recover(made, 2, "sale_id") == 4
    assert total(made.read()) == 4889.92 and same(made.read(), made.read(version=2))
    assert recover(made, 2, "sale_id") is None
    clone.delete("sale_id > 1")
    assert made.read().count() == 8 and clone.read().count() == 1


def test_recovery_sees_lost_added_and_emptied_rows(spark, root):
    made = SnapshotTable.create(spark, f"{root}/sales", "sale_id int, amount double")
    made.append(spark.createDataFrame([(i, float(i)) for i in range(10)], made.schema()))
    good = made.read()
    assert recover(made, 1, "sale_id") is None
    for spoil in (
        lambda: made.delete("sale_id >= 5"),
        lambda: made.update("sale_id < 5", {"amount": "NULL"}),
        lambda: made.append(spark.createDataFrame([(99, 1.0)], made.schema())),
    ):
        spoil()
        assert recover(made, 1, "sale_id") == made.current_version()
        assert same(made.read(), good)


def test_totals_keep_small_amounts(spark):
    assert totals(spark.range(1000).selectExpr("0.004D AS v"), "v").first().total == 4.0


def test_full_diff(spark, root):
    made = sales(spark, root)
    made.delete("sale_id = 3")
    made.append(spark.createDataFrame([(9, None)], made.schema()))
    kinds = version_diff_full(made, 2, made.current_version(), "sale_id").groupBy("diff").count()
    assert rows(kinds, "diff") == [("added", 1), ("changed", 7), ("removed", 1)]


def test_row_diff_is_null_safe_and_refuses_repeated_keys(spark):
    old = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "k int, v int")
    new = spark.createDataFrame([(1, 7), (2, 5), (4, 1)], "k int, v int")
    assert rows(row_diff(old, new, "k"), "k") == [
        (1, "changed", None, 7), (3, "removed", 1, None), (4, "added", None, 1)
    ]
    with pytest.raises(Exception, match="not unique"):
        row_diff(old.union(old), new, "k").collect()


def test_optimize_packs_and_clusters(spark, root):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    made = SnapshotTable.write(spark, f"{root}/o", orders.repartition(8))
    version = made.optimize()
    assert version == 1 and made.detail().first().num_files == 1
    assert same(made.read(), orders) and made.commit().operation == "OPTIMIZE"
    assert made.optimize() == 1  # one file is left alone
    made.optimize(cluster_by="o_custkey", target_bytes=made.detail().first().size_in_bytes // 4)
    assert 3 <= made.detail().first().num_files <= 6 and same(made.read(), orders)
    one = made.read().where("o_custkey = 7").select("_metadata.file_path").distinct().count()
    assert one <= 2


def test_clustering_splits_a_hot_value(spark, root):
    df = spark.range(9000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "uuid() AS pad")
    made = SnapshotTable.write(spark, f"{root}/h", df)
    made.optimize(cluster_by="k", target_bytes=made.detail().first().size_in_bytes // 9)
    per_file = made.read().groupBy("_metadata.file_path").count()
    assert per_file.count() >= 8 and per_file.agg(F.max("count")).first()[0] < 2500


def test_vacuum(spark, staff):
    staff.update("id = 1", {"salary": "1"})
    staff.restore(0)
    staff.overwrite(staff.read(version=1))
    stored = len(glob.glob(f"{staff.root}/data/*/part-*"))
    assert staff.vacuum(dry_run=True).count() == 0
    with pytest.raises(ValueError):
        staff.vacuum(retain_hours=1)
    candidates = staff.vacuum(retain_hours=0, dry_run=True, force=True).count()
    live = staff.detail().first().num_files
    assert candidates == stored - live > 0
    staff.vacuum(retain_hours=0, force=True)
    assert len(glob.glob(f"{staff.root}/data/*/part-*")) == live
    assert staff.read().count() == 5


def test_files_of_an_unfinished_write_are_never_read(spark, staff):
    more = spark.createDataFrame([(11, "Kim", 1)], "id int, name string, salary long")
    more.write.parquet(f"{staff.root}/data/0000000001-deadbeef")
    assert staff.read().count() == 5
    assert staff.vacuum(retain_hours=0, dry_run=True, force=True).count() == len(
        glob.glob(f"{staff.root}/data/0000000001-deadbeef/part-*")
    )
