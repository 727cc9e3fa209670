"""Every SQL-expressible key against DuckDB on the smallest tables, and the
non-SQL keys for rows; the driver repeats this at sf0.01."""

import os

import pytest

import __spark_entry__ as E
from quarry.plans import registry
from tools.oracle_check import compare, duck

SF = os.environ.get("QUARRY_TEST_SF", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, QUERIES[key], ORACLE.get(key), SF, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns
