"""Queries stay whole on data unlike the given tables: new statuses, priorities, months, NULLs."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from check import TABLES, compare, oracle_rows
from millpond.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def put(table, name, values):
    return table.set_column(table.column_names.index(name), name, pa.array(values, table.schema.field(name).type))


@pytest.fixture(scope="module")
def altered(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("altered"))
    for name in TABLES:
        os.symlink(f"{SF}/{name}.parquet", f"{root}/{name}.parquet")
    orders = pq.read_table(f"{SF}/orders.parquet")
    statuses, priorities = orders["o_orderstatus"].to_pylist(), orders["o_orderpriority"].to_pylist()
    for i in range(0, len(statuses), 7):
        statuses[i], priorities[i] = "X", "6-NEVER"
    for i in range(1, len(statuses), 9):
        statuses[i] = priorities[i] = None
    prices = [None if i % 50 == 3 else p + 0.004 for i, p in enumerate(orders["o_totalprice"].to_pylist())]
    orders = put(put(put(orders, "o_orderstatus", statuses), "o_orderpriority", priorities), "o_totalprice", prices)
    events = pq.read_table(f"{SF}/events.parquet")
    times = events["ts"].to_pylist()
    for i, time in enumerate(times):
        year = {1: 2025, 2: 2022}.get(i % 10)
        times[i] = None if i % 40 == 5 else time.replace(year=year) if year else time
    events = put(events, "ts", times)
    for name, table in (("orders", orders), ("events", events)):
        os.remove(f"{root}/{name}.parquet")
        pq.write_table(table, f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", [
    "snapshot_append", "compacted_layout", "cross_join", "left_join", "left_anti", "snapshot_totals", "refused_rows",
    "incremental_total", "watermark_state", "fanout_dept", "fanout_status",
])
def test_whole(spark, altered, name):
    df = QUERIES[name](spark, altered)
    assert compare(df.columns, df.collect(), *oracle_rows(altered, ORACLES[name])) is None


def test_undated_orders_come_with_the_second_load(spark, tmp_path):
    orders = pq.read_table(f"{SF}/orders.parquet")
    dates = orders["o_orderdate"].to_pylist()
    at = orders.schema.get_field_index("o_orderdate")
    dates = pa.array([None if i % 100 == 0 else d for i, d in enumerate(dates)], orders.schema.field(at).type)
    pq.write_table(orders.set_column(at, orders.schema.field(at).name, dates), f"{tmp_path}/orders.parquet")
    early = sum(d is not None and d.year < 1998 for d in dates.to_pylist())
    counts = {r.version: r.row_count for r in QUERIES["version_counts"](spark, str(tmp_path)).collect()}
    assert counts == {0: 0, 1: early, 2: len(dates), 3: len(dates)}
    assert QUERIES["table_detail"](spark, str(tmp_path)).first().row_count == len(dates)
    assert QUERIES["optimize_same_rows"](spark, str(tmp_path)).count() == len(dates)
