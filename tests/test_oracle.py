"""Every registered query against its SQL oracle (DuckDB) on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck

from conftest import SF_SMALL

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL form: held against brute force in a test of its own")
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    ok, _exact, msg = compare(rows, df.columns, rel.fetchall(), rel.columns)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_cost_usd" in df.columns
