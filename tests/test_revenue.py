"""Gold from counted changes: right after any changes and a stop midway, with the changes of silver read once."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan
from millpond.operators.intervals import VersionedRows
from millpond.operators.merge import WhenNotMatched
from millpond.plans.medallion import SILVER_SCHEMA
from millpond.plans.revenue import AMOUNTS_SCHEMA, GOLD_SCHEMA, counted_orders, refresh_revenue


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def expected(silver):
    money = F.sum(F.col("amount").cast("decimal(38,6)"))
    return silver.read().where("status = 'completed'").groupBy("region", "order_date").agg(
        F.count("order_id"), F.count("amount"), F.coalesce(money, F.lit(0)).cast("decimal(38,6)"), F.max("amount")
    ).where("`count(order_id)` > 0 OR `count(amount)` > 0")


def kept(gold):
    return gold.read().select("region", "order_date", "order_count", "amount_count", "exact_revenue", "max_order_value")


def test_gold_follows_counted_changes(spark, root, monkeypatch):
    silver = VersionedRows.create(spark, f"{root}/s", SILVER_SCHEMA)
    amounts = VersionedRows.create(spark, f"{root}/a", AMOUNTS_SCHEMA)
    gold = VersionedRows.create(spark, f"{root}/g", GOLD_SCHEMA)
    silver.append(spark.range(240).select(
        F.when(F.col("id") % 17 != 0, F.col("id")).cast("int").alias("order_id"),
        F.when(F.col("id") % 13 != 0, F.col("id") % 4 + 0.1).alias("amount"),
        F.element_at(F.array(F.lit("North"), F.lit("East"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("region"),
        F.when(F.col("id") % 7 == 0, "pending").otherwise("completed").alias("status"),
        F.when(F.col("id") % 2 == 0, F.expr("DATE '2024-01-01'")).alias("order_date"),
    ))
    # orders of the same amount are one row
    counted = counted_orders(silver, 0, 1)
    assert counted.agg(F.sum("came")).first()[0] == silver.read().where("status = 'completed'").count()
    assert counted.count() == counted.select("region", "order_date", "amount").distinct().count() == 3 * 2 * 3  # two amounts and NULL a group
    reads, changes = [], VersionedRows.changes
    monkeypatch.setattr(VersionedRows, "changes", lambda self, *args: reads.append(self) or changes(self, *args))
    refresh_revenue(silver, amounts, gold)
    assert len(reads) == 1  # for both tables
    assert bag(kept(gold)) == bag(expected(silver))

    silver.update("region = 'North' AND amount > 3", {"region": "'East'"})
    silver.update("region IS NULL", {"amount": "amount + 1"})
    silver.delete("region = 'North' AND order_date IS NULL")
    # a refresh that breaks off between the two tables, and changes before the next one
    with monkeypatch.context() as broken:
        broken.setattr(gold, "merge", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            refresh_revenue(silver, amounts, gold)
    silver.delete("amount > 4")
    refresh_revenue(silver, amounts, gold)
    assert bag(kept(gold)) == bag(expected(silver))
    left = silver.read().where("status = 'completed' AND amount IS NOT NULL")
    assert bag(amounts.read().groupBy("amount").agg(F.sum("orders"))) == bag(left.groupBy("amount").count())


def test_first_merge_takes_all_rows_without_a_join(spark, root, monkeypatch):
    t = VersionedRows.create(spark, f"{root}/t", "k int, v int")
    plans, publish = [], VersionedRows._publish

    def seen(self, operation, rows, *args, **named):
        plans.append(plan(rows))
        return publish(self, operation, rows, *args, **named)

    monkeypatch.setattr(VersionedRows, "_publish", seen)
    source = spark.createDataFrame([(1, 1), (1, 2), (2, 9), (None, 3)], "k int, v int")
    t.merge(source, ["k"], not_matched=[WhenNotMatched("s.v < 9")])
    assert "Join" not in plans[0]
    assert bag(t.read()) == Counter([(1, 1), (1, 2), (None, 3)])
    t.delete("true")  # now empty, but not for the first time
    t.merge(source, ["k"], not_matched=[WhenNotMatched("s.v < 9")])
    assert bag(t.read()) == Counter([(1, 1), (1, 2), (None, 3)])
    t.merge(source, ["k"], not_matched=[WhenNotMatched("s.v < 9")])
    assert bag(t.read()) == Counter([(1, 1), (1, 2), (None, 3), (None, 3)])
