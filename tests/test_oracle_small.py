"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck_connect

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], SQL.get(name), con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "example_id" in df.columns
