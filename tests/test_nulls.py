"""Every registered query against its SQL twin on tables with NULLs in each column but the keys."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from check import TABLES, compare, oracle_rows
from millpond.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
KEYS = {"r_regionkey", "n_nationkey", "c_custkey", "s_suppkey", "p_partkey", "o_orderkey", "l_orderkey", "l_linenumber", "event_id",
        "doc_id", "vec_id", "page_id", "item_id", "conv_id", "turn"}


@pytest.fixture(scope="module")
def holed(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("holed"))
    for name in TABLES:
        table = pq.read_table(f"{SF}/{name}.parquet")
        for at, column in enumerate(table.column_names):
            if column in KEYS:
                continue
            values = table[column].to_pylist()
            values = [None if i % 17 == at % 17 else v for i, v in enumerate(values)]
            field = table.schema.field(column)
            table = table.set_column(at, pa.field(column, field.type, True), pa.array(values, field.type))
        pq.write_table(table, os.path.join(root, f"{name}.parquet"))
    return root


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_with_nulls(spark, holed, name):
    df = QUERIES[name](spark, holed)
    assert compare(df.columns, df.collect(), *oracle_rows(holed, ORACLES[name])) is None
