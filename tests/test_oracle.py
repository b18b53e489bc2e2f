"""Oracle tests: every registered query against its DuckDB statement on the
smallest benchmark folder (row count, column names, value hash)."""

import os

import pytest

import __spark_entry__ as E
from strata import catalog
from tests.oracle_harness import compare, duck

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables not present")

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert res["names_match"], res
    assert res["rows_match"], res
    assert res["hash_match"], res
    spark.catalog.clearCache()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "total_gross_revenue" in df.columns
