"""Landing files taken once each, and counts observed beside a write."""

import os

from pyspark.sql import functions as F

from conftest import rows
from millpond.operators.quality import write_counted
from millpond.streaming.landing import read_taken, take_landed

SCHEMA = "id int, amount double"


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/_{name}", "w") as file:  # names with an underscore wait
        file.write(text)
    os.rename(f"{folder}/_{name}", f"{folder}/{name}")


def test_each_file_counts_once(spark, root):
    landing, args = f"{root}/in", (f"{root}/taken", f"{root}/checkpoint", SCHEMA)

    def run():
        take_landed(spark, landing, *args, files_per_batch=1)
        clean, corrupt = read_taken(spark, args[0], SCHEMA)
        return rows(clean.select("id", "amount")), [r[0] for r in rows(corrupt.select("_corrupt_record"))]

    put(f"{landing}/day=1", "a.csv", "1,1.5\n2,oops\n")
    put(landing, "b.csv", "3,\n")
    assert run() == ([(1, 1.5), (3, None)], ["2,oops"])
    assert run() == ([(1, 1.5), (3, None)], ["2,oops"])  # nothing new
    put(f"{landing}/day=0", "late.csv", "4,4.5\n5,5.5,6\n")
    with open(f"{landing}/_unfinished", "w") as file:
        file.write("9,9")
    assert run() == ([(1, 1.5), (3, None), (4, 4.5)], ["2,oops", "5,5.5,6"])
    clean, _ = read_taken(spark, args[0], SCHEMA)
    assert {r._file.rsplit("/", 1)[1] for r in clean.collect()} == {"a.csv", "b.csv", "late.csv"}


def test_counts_of_a_write(spark, root):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id")))
    counts = write_counted(df, f"{root}/w", large=F.col("v") > 50, missing=F.col("v").isNull())
    assert counts == {"rows": 100, "large": 45, "missing": 10}
    assert spark.read.parquet(f"{root}/w").count() == 100
    assert write_counted(df.limit(0), f"{root}/e", large=F.col("v") > 50) == {"rows": 0, "large": 0}
