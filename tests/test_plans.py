"""Structural checks on physical plans: no Python UDF, pushdown reaches the
scan, fact-level windows are range-partitioned."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["q3_d_ratio_by_district", "q4_j_top_streets", "bq23_lag_diff",
                                 "imbalance_summary", "undersample", "feed_interval_hist"])
def test_no_python_udf(spark, key):
    p = _plan(E.queries()[key](spark, SF))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_pushdown_and_pruning(spark):
    p = _plan(E.queries()["scan_parquet"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,25.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in p


def test_join_pruning(spark):
    # District counts need only lineitem and supplier
    p = _plan(E.queries()["q4_d_domestic_by_district"](spark, SF))
    assert "orders.parquet" not in p and "part.parquet" not in p and "supplier.parquet" in p


def test_single_scan_for_two_counts(spark):
    p = _plan(E.queries()["q3_d_ratio_by_district"](spark, SF))
    assert p.count("lineitem.parquet") == 1


def test_no_window_over_a_whole_group_of_the_fact(spark):
    # the row number comes from positions in the written, range-partitioned frame;
    # the only window runs over one row per slice and group
    p = _plan(E.queries()["bq21_row_number_by_date"](spark, SF))
    windows = [line for line in p.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "__n" in windows[0] and "__pos" in p and "row_number" not in p
