import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        # many small jobs: the quick compiler alone is faster
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Collected rows as tuples, sorted by the given columns or by all."""
    found = df.orderBy(*order).collect() if order else sorted(df.collect(), key=repr)
    return [tuple(r) for r in found]


def plan(df):
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
