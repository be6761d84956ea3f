"""Hot keys: joins split them, aggregates combine them before the shuffle, results stay whole."""

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from millpond.operators.dedup import first_per_key
from millpond.operators.groups import with_group_stats
from millpond.operators.joins import point_in_time_join, without_match
from millpond.operators.merge import WhenMatched, absent_rows, acting_pairs
from millpond.operators.scd import open_history
from millpond.workspace import staged

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "12",
    "spark.sql.files.maxPartitionBytes": "256KB",
    "spark.sql.files.openCostInBytes": "0",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def facts(spark):
    """A third of all rows share key 0."""
    return staged(
        spark.range(0, 120_000, 1, 6).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id", "sha2(string(id), 256) AS pad"),
        "hot",
    )


def ran(df):
    """Rows counted by an action on the very frame, then its final plan."""
    df.write.format("noop").mode("overwrite").save()
    found = df.toArrow().num_rows
    return found, plan(df)


def test_merge_join_splits_a_hot_key(spark, facts, no_broadcast):
    source = staged(facts.select("k").distinct().withColumn("v", F.lit(1)), "source")
    pairs = acting_pairs(facts, source, ["k"], [WhenMatched(None, {"pad": "'x'"})], "left")
    pairs = pairs.select("t.id", "s.v", "t.pad")
    assert pairs.where("v IS NULL").isEmpty()
    found, text = ran(pairs)
    assert found == 120_000
    assert "skew=true" in text


def test_point_in_time_join_splits_a_hot_key(spark, facts, no_broadcast):
    history = staged(open_history(facts.select("k").distinct(), "2020-01-01"), "history")
    dated = facts.withColumn("day", F.expr("DATE '2021-01-01'"))
    found, text = ran(point_in_time_join(dated, history, "k", "day"))
    assert found == 120_000 and "skew=true" in text


def test_group_stats_of_a_hot_group(spark, facts):
    rated = with_group_stats(facts, ["k"], F.count("*").alias("n"))
    assert "BroadcastHashJoin" in plan(rated)
    assert rated.where("k = 0").agg(F.min("n"), F.max("n"), F.count("*")).first()[:] == (40_000, 40_000, 40_000)


def test_copies_combine_before_the_shuffle(spark, facts):
    """The hot group leaves each input partition as one row."""
    picked = first_per_key(facts, ["k"], ["id"])
    assert picked.count() == 80_001  # the hot key and every other id
    assert rows(picked.where("k = 0").select("id")) == [(0,)]
    before_shuffle = plan(picked).split("Exchange")[1]
    assert "partial_min" in before_shuffle and "Window" not in plan(picked)


def test_absent_rows_of_a_hot_source(spark, facts, no_broadcast):
    """Every one of the many source rows with an unknown key is kept."""
    target = facts.where("k > 60000").select("k")
    fresh = absent_rows(facts.select("k", "id"), target, ["k"])
    assert fresh.count() == facts.where("k <= 60000").count()


def test_a_small_source_leaves_the_target_unshuffled(spark, facts):
    few = staged(spark.range(5).selectExpr("id AS k"), "few")
    text = plan(absent_rows(few, facts, ["k"]))
    assert "SortMergeJoin" not in text
    # the only shuffles are of the matched and of the source's own keys
    scan = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(scan) == 2


def test_rows_without_match_see_a_hot_key_once_per_task(spark, facts, no_broadcast):
    keys = spark.range(10).withColumnRenamed("id", "own")
    df = without_match(keys, facts, "own", "k")
    found, text = ran(df)
    assert found == 10 - facts.select("k").distinct().where("k < 10").count()
    assert text.count("HashAggregate") >= 2
