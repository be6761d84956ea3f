"""MERGE, change feed, dimensions, increments and layers: known answers and invariants."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from conftest import rows
from millpond.operators.joins import point_in_time_join
from millpond.operators.merge import AmbiguousMerge, WhenMatched, WhenNotMatched, merge_frames
from millpond.operators.scd import current_rows, open_history, scd2_apply, scd2_merge
from millpond.operators.snapshot import FEED_PROPERTY, SnapshotTable
from millpond.plans.fanout import fanout
from millpond.plans.incremental import control_table, incremental_load, watermark
from millpond.plans.medallion import open_layers, refresh
from millpond.streaming.feed import read_log, stream_changes
from millpond.streaming.propagate import propagate

CLAUSES = dict(
    matched=[
        WhenMatched("s.op_type = 'D'", delete=True),
        WhenMatched("s.op_type = 'U'", {"email": "s.email", "status": "s.status", "is_deleted": "false"}),
    ],
    not_matched=[WhenNotMatched("s.op_type = 'I'", {
        "customer_id": "s.customer_id", "name": "s.name", "email": "s.email", "status": "s.status",
        "is_deleted": "false",
    })],
)


def replay(spark, before, changes, key):
    """Apply change rows to a frame: what the feed says must be what happened."""
    after = changes.where("_change_type IN ('insert', 'update_postimage')").select(*before.columns)
    gone = changes.where("_change_type IN ('delete', 'update_preimage')").select(*before.columns)
    return before.exceptAll(gone).unionAll(after)


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def customers(spark):
    df = spark.createDataFrame(fx.CUSTOMERS, fx.CUSTOMERS_SCHEMA).where("customer_id != 4")
    return df.withColumn("is_deleted", F.col("customer_id") == 5)


def changes_source(spark):
    return spark.createDataFrame(fx.CUSTOMER_CHANGES, fx.CUSTOMERS_SCHEMA + ", op_type string")


@pytest.mark.parametrize("feed", ["false", "true"])
def test_cdc_merge(spark, root, feed):
    made = SnapshotTable.write(spark, f"{root}/c", customers(spark), {FEED_PROPERTY: feed})
    made.merge(changes_source(spark), ["customer_id"], **CLAUSES)
    found = rows(made.read(), "customer_id")
    assert [r[0] for r in found] == [2, 3, 5, 6, 7]
    assert found[0][2] == "bob.updated@email.com"
    assert found[2][4] is True  # soft-deleted stays so
    assert made.commit().operation == "MERGE"
    if feed == "true":
        seen = made.changes(1)
        kinds = {r[0]: r[1] for r in seen.groupBy("_change_type").count().collect()}
        assert kinds == {"delete": 1, "insert": 2, "update_preimage": 1, "update_postimage": 1}
        assert same(replay(spark, made.read(version=0), seen, "customer_id"), made.read())
    else:
        assert made.changes(0).count() == 0


def test_frames_and_tables_merge_alike(spark, root):
    made = SnapshotTable.write(spark, f"{root}/c", customers(spark))
    made.merge(changes_source(spark), ["customer_id"], **CLAUSES)
    result, changed = merge_frames(customers(spark), changes_source(spark), ["customer_id"], **CLAUSES)
    assert same(result, made.read())
    assert same(replay(spark, customers(spark), changed, "customer_id"), result)


def test_unfitting_codes_are_ignored(spark, root):
    made = SnapshotTable.write(spark, f"{root}/c", customers(spark))
    odd = [(3, "Carol", "x", "x", "I"), (90, "New", "x", "x", "U"), (91, "New", "x", "x", "D")]
    made.merge(spark.createDataFrame(odd, fx.CUSTOMERS_SCHEMA + ", op_type string"), ["customer_id"], **CLAUSES)
    assert same(made.read(), customers(spark))


def test_update_revives_a_soft_deleted_row(spark, root):
    made = SnapshotTable.write(spark, f"{root}/c", customers(spark))
    source = spark.createDataFrame([(5, "Eve", "e", "active", "U")], fx.CUSTOMERS_SCHEMA + ", op_type string")
    made.merge(source, ["customer_id"], **CLAUSES)
    assert rows(made.read().where("customer_id = 5").select("status", "is_deleted")) == [("active", False)]


def test_clause_order_decides(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b")], "k int, v string")
    first, _ = merge_frames(target, source, ["k"], [WhenMatched(None, {"v": "'one'"}), WhenMatched(None, delete=True)])
    assert rows(first) == [(1, "one")]
    second, _ = merge_frames(target, source, ["k"], [WhenMatched(None, delete=True), WhenMatched(None, {"v": "'one'"})])
    assert rows(second) == []


def test_ambiguous_source(spark, root):
    target = spark.createDataFrame([(1, 0), (2, 0)], "k int, v int")
    twice = spark.createDataFrame([(1, 5), (1, 6), (9, 7), (9, 8)], "k int, v int")
    update = [WhenMatched(None, {"v": "s.v"})]
    made = SnapshotTable.write(spark, f"{root}/t", target)
    with pytest.raises(AmbiguousMerge):
        made.merge(twice, ["k"], update)
    with pytest.raises(AmbiguousMerge):
        merge_frames(target, twice, ["k"], update)
    # only one of the two source rows acts on the target row; unmatched repeats are all inserted
    made.merge(twice, ["k"], [WhenMatched("s.v = 6", {"v": "s.v"})], [WhenNotMatched()])
    assert rows(made.read(), "k", "v") == [(1, 6), (2, 0), (9, 7), (9, 8)]


def test_null_keys_never_match(spark, root):
    target = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    made = SnapshotTable.write(spark, f"{root}/t", target)
    made.merge(target, ["k"], [WhenMatched(None, delete=True)], [WhenNotMatched()])
    assert rows(made.read()) == [(None, 1), (None, 1)]


def test_insert_only_merge_is_idempotent(spark, root):
    made = SnapshotTable.write(spark, f"{root}/e", spark.createDataFrame([("E001", 1), ("E002", 2)], "id string, u int"))
    late = spark.createDataFrame([("E001", 9), ("E003", 3)], "id string, u int")
    made.merge(late, ["id"], not_matched=[WhenNotMatched()])
    made.merge(late, ["id"], not_matched=[WhenNotMatched()])
    assert rows(made.read(), "id") == [("E001", 1), ("E002", 2), ("E003", 3)]


def test_merge_rewrites_only_touched_files(spark, root):
    df = spark.range(800).selectExpr("id", "0 AS x").repartitionByRange(8, "id")
    made = SnapshotTable.write(spark, f"{root}/t", df)
    before = set(made.read().inputFiles())
    made.merge(spark.createDataFrame([(3, 1), (900, 2)], "id long, x int"), ["id"],
               [WhenMatched(None, {"x": "s.x"})], [WhenNotMatched()])
    assert len(before & set(made.read().inputFiles())) == 7
    assert rows(made.read().where("x > 0"), "id") == [(3, 1), (900, 2)]


def test_hot_key_in_source_and_target(spark, root):
    """A third of all target rows share one key; all are updated by one source row."""
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "0 AS x")
    made = SnapshotTable.write(spark, f"{root}/t", df)
    made.merge(spark.createDataFrame([(-1, 7)], "k long, x int"), ["k"], [WhenMatched(None, {"x": "s.x"})])
    assert made.read().where("x = 7").count() == 1000 and made.read().count() == 3000


# ---- change feed ---------------------------------------------------------------------------


def products(spark, root):
    made = SnapshotTable.create(spark, f"{root}/p", fx.PRODUCTS_SCHEMA, {FEED_PROPERTY: "true"})
    made.append(spark.createDataFrame(fx.PRODUCTS, fx.PRODUCTS_SCHEMA))
    return made


def change_products(spark, made):
    made.update("product_id = 1", {"price": "1099.99"})
    made.update("product_id = 2", {"in_stock": "false"})
    made.delete("product_id = 5")
    made.append(spark.createDataFrame(fx.MORE_PRODUCTS, fx.PRODUCTS_SCHEMA))


def test_feed_rows(spark, root):
    made = products(spark, root)
    change_products(spark, made)
    feed = made.changes(1)
    assert feed.count() == 12 and made.changes(2, 3).count() == 4
    kinds = {r[0]: r[1] for r in feed.groupBy("_change_type").count().collect()}
    assert kinds == {"insert": 7, "update_preimage": 2, "update_postimage": 2, "delete": 1}
    prices = feed.where("product_id = 1 AND _commit_version = 2").select("_change_type", "price")
    assert rows(prices) == [("update_postimage", 1099.99), ("update_preimage", 999.99)]
    assert feed.where("_commit_timestamp IS NULL").isEmpty()


def test_replaying_any_range_gives_its_end(spark, root):
    made = products(spark, root)
    change_products(spark, made)
    made.restore(2)
    made.add_columns("note string")
    made.update("product_id = 3", {"note": "'x'"})
    made.overwrite(made.read().where("product_id < 4"))
    last = made.current_version()
    schema = made.read().columns
    for version in range(1, last + 1):
        before = made.read(version=version - 1)
        for column in schema:
            if column not in before.columns:
                before = before.withColumn(column, F.lit(None).cast("string"))
        after = made.read(version=version)
        got = replay(spark, before.select(*schema), made.changes(version, version), "product_id")
        assert same(got.select(*after.columns), after), version


def test_feed_is_off_by_default_and_starts_when_enabled(spark, root):
    made = SnapshotTable.write(spark, f"{root}/p", spark.createDataFrame(fx.PRODUCTS, fx.PRODUCTS_SCHEMA))
    made.delete("product_id = 5")
    made.set_properties({FEED_PROPERTY: "true"})
    assert made.changes(0).count() == 0
    made.delete("product_id = 4")
    assert made.changes(0).count() == 1
    assert made.optimize(cluster_by="product_id") == 4 and made.changes(0).count() == 1


def test_unfinished_changes_are_not_in_the_feed(spark, root):
    made = products(spark, root)
    made.changes(1).write.parquet(f"{made.root}/changes/0000000002-deadbeef")
    assert made.changes(0).count() == 5
    log, checkpoint = f"{root}/log", f"{root}/ck"
    stream_changes(made, log, checkpoint)
    assert read_log(made, log).count() == 5


def test_stream_takes_each_commit_once(spark, root):
    made = products(spark, root)
    log, checkpoint = f"{root}/log", f"{root}/ck"
    stream_changes(made, log, checkpoint, starting_version=1)
    assert read_log(made, log).count() == 5
    stream_changes(made, log, checkpoint, starting_version=1)
    assert read_log(made, log).count() == 5
    change_products(spark, made)
    stream_changes(made, log, checkpoint, starting_version=1)
    assert same(read_log(made, log), made.changes(1))


def test_propagation(spark, root):
    made = products(spark, root)
    belongs = F.col("category") == "Electronics"
    summary = SnapshotTable.write(
        spark, f"{root}/s", made.read().where(belongs).select("product_id", "name", "price", "in_stock")
    )
    change_products(spark, made)
    made.update("product_id = 3", {"category": "'Accessories'"})  # leaves the group
    made.update("product_id = 6", {"price": "350.0"})  # inserted and changed in the range
    propagate(made, summary, "product_id", belongs, starting_version=2)
    want = made.read().where(belongs).select("product_id", "name", "price", "in_stock")
    assert same(summary.read(), want)
    version = summary.current_version()
    propagate(made, summary, "product_id", belongs, starting_version=2)  # again: same rows
    assert same(summary.read(), want) and summary.current_version() >= version


# ---- dimensions -------------------------------------------------------------------------------


DIM = "customer_id string, name string, address string"


def dimension(spark):
    people = [("C001", "Alice Smith", "123 Oak Ave"), ("C002", "Bob Jones", "99 Jump St"),
              ("C003", "Carol White", "1000 Rodeo Dr")]
    return open_history(spark.createDataFrame(people, DIM), "2020-01-01")


def moves(spark):
    return spark.createDataFrame(
        [("C001", "Alice Smith", "430 River Rd"), ("C002", "Bob Jones", "99 Jump St"), ("C009", "Zoe", "1 New St")], DIM
    )


def test_scd2(spark, root):
    dim = scd2_apply(dimension(spark), moves(spark), "customer_id", ["address"], "2024-01-20")
    assert dim.count() == 5
    alice = dim.where("customer_id = 'C001'").select(
        "address", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_current")
    assert rows(alice, "valid_from") == [
        ("123 Oak Ave", "2020-01-01", "2024-01-20", False), ("430 River Rd", "2024-01-20", None, True),
    ]
    assert rows(current_rows(dim).select("customer_id"), "customer_id") == [("C001",), ("C002",), ("C003",), ("C009",)]
    table = SnapshotTable.write(spark, f"{root}/dim", dimension(spark))
    scd2_merge(table, moves(spark), "customer_id", ["address"], "2024-01-20")
    assert same(table.read(), dim)
    version = table.current_version()
    scd2_merge(table, moves(spark), "customer_id", ["address"], "2024-02-01")  # nothing differs any more
    assert same(table.read(), dim) and table.current_version() <= version + 1


def test_point_in_time_is_half_open(spark):
    dim = scd2_apply(dimension(spark), moves(spark), "customer_id", ["address"], "2024-01-20")
    orders = spark.createDataFrame(
        [(1, "C001", "2024-01-15"), (2, "C001", "2024-01-20"), (3, "C001", "2024-01-19"), (4, "C009", "2024-01-01")],
        "order_id int, customer_id string, day string",
    ).withColumn("day", F.col("day").cast("date"))
    found = point_in_time_join(orders, dim, "customer_id", "day").select("order_id", "address")
    assert rows(found, "order_id") == [(1, "123 Oak Ave"), (2, "430 River Rd"), (3, "123 Oak Ave")]


# ---- increments -----------------------------------------------------------------------------------


def test_incremental_loads(spark, root):
    first = spark.createDataFrame(fx.TRANSACTIONS, fx.TRANSACTIONS_SCHEMA)
    both = first.unionAll(spark.createDataFrame(fx.NEW_TRANSACTIONS, fx.TRANSACTIONS_SCHEMA))
    sink = SnapshotTable.create(spark, f"{root}/bronze", first.schema)
    control = control_table(spark, f"{root}/control", "transactions", "2024-01-15 00:00:00")
    load = lambda source: incremental_load(source, sink, control, "transactions", "txn_id", "updated_at")
    assert load(first) == 5
    assert str(watermark(control, "transactions")) == "2024-01-17 10:00:00"
    assert load(first) == 0
    assert load(both) == 3
    assert str(watermark(control, "transactions")) == "2024-01-19 09:00:00"
    assert sink.read().count() == 8
    assert [r[0] for r in rows(sink.differing_rows(1, 2)[1].select("txn_id"), "txn_id")] == [6, 7, 8]
    # a late row with the very time of the mark is not lost
    tie = both.unionAll(spark.createDataFrame([(9, 1.0, "2024-01-19 09:00:00")], fx.TRANSACTIONS_SCHEMA))
    assert load(tie) == 1 and sink.read().count() == 9
    # a changed row comes again with its new time
    changed = tie.unionAll(spark.createDataFrame([(1, 5.0, "2024-01-20 00:00:00")], fx.TRANSACTIONS_SCHEMA))
    assert load(changed) == 1 and sink.read().where("txn_id = 1").count() == 2


def test_rows_without_a_change_time_are_set_aside(spark, root):
    schema = "txn_id int, amount double, updated_at string"
    source = spark.createDataFrame([(1, 1.0, "2024-01-16 00:00:00"), (2, 2.0, None), (3, 3.0, "soon")], schema)
    sink = SnapshotTable.create(spark, f"{root}/bronze", source.schema)
    control = control_table(spark, f"{root}/control", "transactions", "2024-01-15 00:00:00")
    with pytest.raises(ValueError):
        incremental_load(source, sink, control, "transactions", "txn_id", "updated_at")
    undated = SnapshotTable.create(spark, f"{root}/undated", source.schema)
    for expected in (1, 0):
        assert incremental_load(source, sink, control, "transactions", "txn_id", "updated_at", undated) == expected
        assert [r[0] for r in rows(undated.read().select("txn_id"), "txn_id")] == [2, 3]


def test_layers_refuse_bronze_rows_that_were_not_appended(spark, root):
    layers = open_layers(spark, root)
    layers.bronze.append(spark.createDataFrame([], layers.bronze.schema()))
    layers.bronze.overwrite(spark.createDataFrame([(None, "f", "{}")], layers.bronze.schema()))
    with pytest.raises(ValueError):
        refresh(layers)


def test_a_load_repeated_after_a_crash_adds_nothing_twice(spark, root):
    first = spark.createDataFrame(fx.TRANSACTIONS, fx.TRANSACTIONS_SCHEMA)
    sink = SnapshotTable.create(spark, f"{root}/bronze", first.schema)
    control = control_table(spark, f"{root}/control", "transactions", "2024-01-15 00:00:00")
    sink.append(first)  # rows arrived, the mark did not move
    assert incremental_load(first, sink, control, "transactions", "txn_id", "updated_at") == 0
    assert sink.read().count() == 5


# ---- layers ------------------------------------------------------------------------------------------


def test_layers(spark, root):
    layers = open_layers(spark, root)
    for day, payloads in fx.BRONZE.items():
        batch = spark.createDataFrame([(p,) for p in payloads], "raw_payload string").select(
            F.lit(f"{day} 08:00:00").cast("timestamp").alias("ingestion_timestamp"),
            F.lit(f"orders_{day}.json").alias("source_file"), "raw_payload",
        )
        layers.bronze.append(batch)
        if day == "2024-01-15":
            refresh(layers)
    refresh(layers)
    refresh(layers)
    assert layers.bronze.read().count() == 8
    assert [r[0] for r in rows(layers.silver.read().select("order_id"), "order_id")] == [1, 2, 3, 4, 6]
    assert [r[0] for r in rows(layers.quarantine.read().select("order_id"), "order_id")] == [5, 7]
    assert layers.gold.read().count() == 4
    kept = layers.silver.read().where("order_id = 1").first()
    assert kept.source_file == "orders_2024-01-15.json"  # the first delivery


def test_unreadable_payload_goes_to_quarantine(spark, root):
    layers = open_layers(spark, root)
    layers.bronze.append(spark.createDataFrame([("{oops",), ('{"order_id":"x","amount":1}',)], "raw_payload string").select(
        F.current_timestamp().alias("ingestion_timestamp"), F.lit("f").alias("source_file"), "raw_payload"))
    refresh(layers)
    assert layers.quarantine.read().count() == 2 and layers.silver.read().count() == 0


def test_fanout(spark, root):
    facts = spark.createDataFrame(
        [("N", "HR", "ok", 10), ("N", "IT", "ok", 20), ("S", "HR", "no", 30), ("S", "HR", "no", -1), ("X", "HR", "no", 5)],
        "region string, dept string, status string, amount int",
    )
    money = spark.createDataFrame([("N", "USD"), ("S", "GBP")], "region string, currency string")
    written, bad = fanout(
        facts, money, "region", F.col("amount") > 0,
        {"dept": ["dept"], "region": ["region", "currency"], "status": ["status"]},
        [F.count("*").alias("n"), F.sum("amount").alias("total")], f"{root}/out",
    )
    assert bad == 1
    assert rows(written["dept"], "dept") == [("HR", 2, 40), ("IT", 1, 20)]
    assert rows(written["region"], "region") == [("N", "USD", 2, 30), ("S", "GBP", 1, 30)]
    assert rows(written["status"], "status") == [("no", 1, 30), ("ok", 2, 30)]
