"""Queries that SQL can express against DuckDB; all others for rows."""

import os

import pytest

from quarry.llm import registry
from tools.oracle_check import compare, duck

SF = os.environ.get("QUARRY_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    r = compare(spark, key, QUERIES[key], ORACLE.get(key), SF, duck(SF))
    assert r["status"] in ("ok", "rows-only") and r["rows"], r


def test_thirteen_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
