"""The merging as-of join against the plain join by key and range."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan
from millpond.operators.joins import as_of_join, point_in_time_join

DAY = datetime.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


def tables(spark, seed, hot):
    """Histories with gaps, open ends and rows of no length; facts on borders, before and after; NULLs; one hot key."""
    rng = random.Random(seed)
    history, facts = [], []
    for key in range(30):
        at = rng.randint(0, 20)
        for step in range(rng.randint(0, 400 if key == 0 and hot else 6)):
            end = at + rng.choice([0, 1, 3, 10])
            history.append((key, f"{key}/{step}", day(at), day(end)))
            at = end + rng.choice([0, 0, 2])
        if rng.random() < 0.7:
            history.append((key, f"{key}/open", day(at), None))
    history += [(None, "no key", day(0), None)]
    for i in range(600):
        key = 0 if hot and i % 3 == 0 else rng.choice([None, *range(33)])
        facts.append((i // 2, key, day(rng.choice([None, *range(80), 2000]))))
    return (
        spark.createDataFrame(facts, "id int, k int, d date"),
        spark.createDataFrame(history, "k int, name string, valid_from date, valid_to date").repartition(3),
    )


@pytest.mark.parametrize("seed, hot, parts", [(1, False, 4), (2, True, 4), (3, True, 40), (4, False, 1)])
def test_same_rows_as_the_plain_join(spark, seed, hot, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts, history = tables(spark, seed, hot)
        merged = as_of_join(facts, history, "k", "d")
        plain = point_in_time_join(facts, history, "k", "d")
        assert merged.columns == plain.columns
        assert Counter(map(tuple, merged.collect())) == Counter(map(tuple, plain.collect())) != Counter()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_sides(spark):
    facts, history = tables(spark, 1, False)
    assert as_of_join(facts.limit(0), history, "k", "d").count() == 0
    assert as_of_join(facts, history.limit(0), "k", "d").count() == 0


def test_a_hot_key_is_not_compared_pair_by_pair(spark):
    """A third of facts and history on one key: no join on the key alone, and it lies in many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = spark.range(0, 6000).withColumn("k", F.expr("IF(id % 3 = 0, 0, id)"))
        history = ids.select("k", (F.col("id") % 2000).cast("int").alias("n")).select(
            "k", F.date_add(F.lit(DAY), F.col("n")).alias("valid_from"), F.date_add(F.lit(DAY), F.col("n") + 1).alias("valid_to")
        ).distinct()
        facts = ids.select("id", "k", F.date_add(F.lit(DAY), (F.col("id") * 7 % 2000).cast("int")).alias("d"))
        found = as_of_join(facts, history, "k", "d")
        assert found.where("k = 0").count() == point_in_time_join(facts, history, "k", "d").where("k = 0").count()
        text = plan(found)
        joins = [line for line in text.splitlines() if "Join" in line]
        assert joins and all("_of_part" in line for line in joins)
        events = [f for f in found.inputFiles() if "as-of-events" in f]
        hot = spark.read.parquet(*events).where("_key = 0")
        assert hot.select("_part").distinct().count() >= 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
