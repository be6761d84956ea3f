"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads, ``BENCH_RUNS``
the timed runs after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from check import session
from millpond.queries import QUERIES

HEADLINE = [
    # scans, aggregates, group comparisons
    "filter_group_sort", "scan_parquet", "group_two_keys", "duplicate_keys", "anomaly_counts",
    "above_group_avg", "top_per_group", "dedup_by_key", "top_n",
    # joins
    "inner_join", "broadcast_join", "sort_merge_join", "full_outer_join", "left_anti_alias", "using_join",
    "scd2_point_in_time",
    # functions
    "json_extract", "parse_date", "map_lookup", "map_lookup_udf",
    # files
    "csv_permissive_split", "json_explicit", "partition_pruned_scan",
    # versioned tables
    "update_expr", "delete_rows", "merge_cdc", "merge_insert_only", "version_diff", "optimize_same_rows",
    "scd2_merge", "cdf_stream_log", "silver_orders", "incremental_total", "fanout_region",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in names:
        timed = []
        for run in range(runs + 1):
            start = time.perf_counter()
            # the noop sink runs the whole plan without bringing rows to the driver
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed), 3)
        print(f"{name:24s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
