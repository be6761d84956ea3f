"""Registration of queries and access to the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millpond.workspace import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with the SQL that must give the same rows."""

    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_database(spark: SparkSession) -> str:
    """A fresh schema of the catalog whose managed tables live in the shared work folder."""
    name = f"millpond_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, 'db')}'")
    return name


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The table as a temporary view for SQL text."""
    table(spark, sf_dir, name).createOrReplaceTempView(name)
    return name
