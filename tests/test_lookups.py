"""Lookups of known size: what moves when they are small, and when they are not."""

import re

import pytest
from pyspark.sql import functions as F

from quarry.operators.agg import heatmap_pivot
from quarry.operators.impute import impute_mean_hierarchy, impute_mode
from quarry.operators.joins import lookup_join, settled
from quarry.operators.materialize import ROW, SLICE, buckets_of, numbered
from quarry.plans import preprocess

SF = "/root/testdata/sf0.001"
LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(params=["10m", "1"])
def limit(spark, request):
    """With lookups that are broadcast, and with lookups that all count as large."""
    before, adaptive = spark.conf.get(LIMIT), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(LIMIT, request.param)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it begins
    yield request.param
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set(LIMIT, before)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def exchanges(df) -> list[list[str]]:
    """The columns that each shuffle of the plan carries."""
    jvm = df.sparkSession._jvm
    plan = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [[re.sub(r"#\d+L?$", "", c) for c in m.split(", ")]
            for m in re.findall(r"\) Exchange\s*\n(?:Input|Output) ?\[\d+\]: \[([^\]]*)\]", plan)]


def test_no_shuffle_carries_the_features(spark, limit):
    feats = preprocess.features(spark, SF)
    out = preprocess.chain(feats, "coordinates")
    moved = exchanges(out)
    payload = {"incident_date", "block", "arrest", "domestic", "order_key"}
    assert not any(payload & set(columns) for columns in moved), moved
    if limit != "1":
        assert not [c for c in moved if SLICE in c or "beat" in c], moved  # small lookups move nothing
    else:
        assert [c for c in moved if "__r_row" in c], moved
    assert out.columns == [c for c in feats.columns if c not in (SLICE, ROW)]


def test_large_and_small_lookups_give_the_same(spark, limit):
    rows = [(i, None if i % 7 == 0 else i % 5, None if i % 3 == 0 else f"v{i % 4}", "x" * (i % 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k int, v string, payload string").repartition(5)
    lookup = settled(spark.createDataFrame([(0, "zero"), (1, "one"), (3, "three"), (99, "never")], "k int, name string"))
    want = sorted((i, {0: "zero", 1: "one", 3: "three"}.get(k) if v is None else None) for i, k, v, _ in rows)
    for table in (df, numbered(df, "test")):
        out = lookup_join(table, lookup, ["k"], ["name"], needed=F.col("v").isNull())
        assert sorted((r.id, r.name) for r in out.collect()) == want
        assert out.columns == [*table.columns, "name"]
    out = lookup_join(numbered(df, "test"), lookup, ["k"], ["name"])
    assert sorted((r.id, r.name) for r in out.collect()) == sorted(
        (i, {0: "zero", 1: "one", 3: "three"}.get(k)) for i, k, _, _ in rows)


def test_imputers_on_numbered_tables(spark, limit):
    rows = [(i, i % 11, i % 3, None if i % 4 == 0 else i % 6, None if i % 5 == 0 else float(i % 13)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, a int, b int, t int, x double")
    table = numbered(df, "test")
    assert buckets_of(table) and table.select("id").distinct().count() == 600
    plain = impute_mode(df, "t", [["a", "b"], ["a"]])
    filled = impute_mode(table, "t", [["a", "b"], ["a"]]).drop(SLICE, ROW)
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, plain.collect()))
    plain = impute_mean_hierarchy(df, ["x"], ["a", "b"], 8)
    filled = impute_mean_hierarchy(table, ["x"], ["a", "b"], 8).drop(SLICE, ROW)
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, plain.collect()))


def test_heat_map_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "b"), (2, "z"), (None, "a")], "r int, c string")
    got = {r.r: r.asDict() for r in heatmap_pivot(df, "r", "c", ["a", "b", "never"]).collect()}
    assert got[1] == {"r": 1, "a": 2, "b": 0, "never": 0, "null": 1, "other": 0}
    assert got[2]["b"] == got[2]["other"] == 1 and got[None]["a"] == 1
    free = {r.r: r.asDict() for r in heatmap_pivot(df, "r", "c").collect()}
    assert free[1] == {"r": 1, "a": 2, "b": 0, "z": 0, "null": 1}
