"""Differences of two stored tables by digests: only buckets that differ are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.operators.diff import row_diff

#: Buckets of the keys; also the most numbers of differing buckets that the driver sees.
BUCKETS = 256


def write_digested(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Rows in a folder per bucket of their key, and a small table of digests beside them.

    A digest does not depend on the order of rows: their number, the sum and
    the exclusive or of their hashes.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = df.withColumn("_bucket", bucket)
    # the hint splits the bucket of a hot key over several tasks
    rows.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows")
    names = sorted(df.columns)
    hashed = df.select(bucket.alias("_bucket"), F.xxhash64(*[F.col(f"`{c}`") for c in names], *[F.col(f"`{c}`").isNull() for c in names]).alias("hash"))
    hashed.groupBy("_bucket").agg(
        F.count("*").alias("rows"), F.sum(F.col("hash").cast("decimal(20,0)")).alias("total"), F.bit_xor("hash").alias("parity")
    ).write.mode("overwrite").parquet(f"{path}/digests")


def differing_buckets(spark: SparkSession, left: str, right: str) -> list[int]:
    """Numbers of the buckets whose digests differ, at most as many as there are buckets."""
    old, new = (spark.read.parquet(f"{path}/digests") for path in (left, right))
    parts = ["rows", "total", "parity"]
    both = old.select("_bucket", *[F.col(c).alias(f"old_{c}") for c in parts]).join(new, "_bucket", "full")
    same = F.lit(True)
    for c in parts:
        same &= F.col(f"old_{c}").eqNullSafe(F.col(c))
    return [r[0] for r in both.where(~same).select("_bucket").collect()]


def digest_diff(spark: SparkSession, left: str, right: str, key: str) -> DataFrame:
    """``row_diff`` of two digested tables of the same columns and buckets, from the buckets that differ alone."""
    wanted = differing_buckets(spark, left, right)
    old, new = (
        spark.read.parquet(f"{path}/rows").where(F.col("_bucket").isin(wanted) if wanted else F.lit(False)).drop("_bucket")
        for path in (left, right)
    )
    return row_diff(old, new, key)
