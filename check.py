"""Run registered queries next to their SQL twins: ``python check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="millpond-work-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def compare(columns, rows, want_columns, want_rows) -> str | None:
    """None when equal as bags of rows, with columns taken by name; else what differs."""
    if sorted(columns) != sorted(want_columns):
        return f"columns {sorted(columns)} != {sorted(want_columns)}"

    def bag(names, data):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in data)

    got, want = bag(columns, rows), bag(want_columns, want_rows)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return f"{len(rows)} vs {len(want_rows)} rows; extra {list(extra)[:2]}; missing {list(missing)[:2]}"


def main(argv: list[str]) -> int:
    from millpond.queries import ORACLES, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            rows = df.collect()
            if name in ORACLES:
                problem = compare(df.columns, rows, *oracle_rows(sf_dir, ORACLES[name]))
                word = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, word = None, "rows only"
        except Exception as error:  # noqa: BLE001
            rows, problem, word = [], "error", f"ERROR {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {len(rows):7d} {word}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
