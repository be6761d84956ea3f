"""Shared work folder, and tables written there to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a folder is made up in local mode alone,
    where the driver is also the only executor, and goes with the process. On
    a cluster an unset folder is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="millpond-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the work folder; nothing exists there yet."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write ``df`` once and read it back.

    Survives the loss of executors, fixes the value of non-deterministic
    expressions, and gives the planner the real size in bytes, so that it
    broadcasts the result below ``autoBroadcastJoinThreshold`` and shuffles
    it above.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
