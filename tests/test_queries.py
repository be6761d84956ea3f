"""Every registered query against its SQL twin, on the smallest given tables."""

import pytest

from check import compare, oracle_rows
from millpond.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    found = df.collect()
    if name in ORACLES:
        assert compare(df.columns, found, *oracle_rows(SF, ORACLES[name])) is None
    else:
        assert df.columns


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 5
