"""Bucketed merges and digest diffs: results as the plain forms, and what they read and shuffle."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan
from millpond.operators.bucketed import merge_bucketed, merged_buckets, write_bucketed
from millpond.operators.diff import row_diff
from millpond.operators.digests import differing_buckets, digest_diff, write_digested
from millpond.operators.merge import AmbiguousMerge, WhenMatched, WhenNotMatched, merge_frames
from millpond.queries.registry import fresh_database

MATCHED = [WhenMatched("s.op = 'D'", delete=True), WhenMatched("s.op = 'U'", {"v": "s.v"})]
NEW = [WhenNotMatched("s.op = 'I'", {"k": "s.k", "v": "s.v"}), WhenNotMatched("s.op = 'N'")]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def sides(spark):
    target = spark.createDataFrame([(i, i) for i in range(40)] + [(None, 7), (3, 33)], "k int, v int")
    source = spark.createDataFrame(
        [(i, 100 + i, "DUIX"[i % 4]) for i in range(0, 60, 3)] + [(None, 1, "I"), (None, 2, "D"), (70, 5, "N")], "k int, v int, op string"
    )
    return target, source


def test_bucketed_merge_shuffles_the_source_alone(spark):
    target, source = sides(spark)
    name = f"{fresh_database(spark)}.t"
    write_bucketed(target, name, ["k"], 4)
    want = bag(merge_frames(target, source, ["k"], MATCHED, NEW)[0])
    rows = merged_buckets(spark, name, source, ["k"], MATCHED, NEW)
    assert bag(rows) == want
    text = plan(rows).split("== Initial Plan ==")[0]
    assert text.count("Exchange") == 1 and "Bucketed: true" in text
    merge_bucketed(spark, name, source, ["k"], 4, MATCHED, NEW)
    assert bag(spark.table(name)) == want
    again = merged_buckets(spark, name, source, ["k"], MATCHED, NEW)
    again.collect()
    assert plan(again).split("== Initial Plan ==")[0].count("Exchange") == 1
    with pytest.raises(AmbiguousMerge):
        merged_buckets(spark, name, source.unionByName(source), ["k"], MATCHED, NEW)


def test_a_changed_row_reads_one_bucket(spark, root):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 2).alias("v"), F.lit("x").alias("s"))
    changed = df.withColumn("v", F.when(F.col("id") == 1234, F.lit(None)).otherwise(F.col("v")))
    for name, rows in (("a", df), ("b", changed), ("c", df.repartition(7)), ("d", df.where("id != 5").unionByName(df.limit(0)))):
        write_digested(rows, f"{root}/{name}", "id", 16)
    found = digest_diff(spark, f"{root}/a", f"{root}/b", "id")
    assert [(r.id, r["diff"], r.old_v, r.new_v) for r in found.collect()] == [(1234, "changed", 2468, None)]
    assert len({f.split("_bucket=")[1].split("/")[0] for f in spark.read.parquet(f"{root}/a/rows").inputFiles()}) == 16
    assert len(differing_buckets(spark, f"{root}/a", f"{root}/b")) == 1
    assert "PartitionFilters: [isnotnull(_bucket" in plan(found)
    assert differing_buckets(spark, f"{root}/a", f"{root}/c") == []
    assert digest_diff(spark, f"{root}/a", f"{root}/c", "id").count() == 0
    gone = digest_diff(spark, f"{root}/a", f"{root}/d", "id")
    assert [(r.id, r["diff"]) for r in gone.collect()] == [(5, "removed")]
    assert bag(gone) == bag(row_diff(df, df.where("id != 5"), "id"))
