"""Versioned tables, rejected lines, distinct counts, duplicate rows, dense ranks."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.agg import SKETCH_ERROR, distinct_counts, duplicate_rows
from quarry.operators.materialize import scratch_table
from quarry.operators.windows import dense_rank_all
from quarry.sources.io import VersionedTable, scan_csv_checked

DATA = "/root/testdata/sf0.001"


def _formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_rewrites_and_a_reader_of_the_old_version(spark):
    t = VersionedTable(spark, scratch_table(spark, "versions"))
    with pytest.raises(ValueError):
        t.read()
    assert t.commit(spark.range(5)) == 1
    old = t.read()
    assert t.rewrite(lambda d: d.where("id > 1")) == 2
    assert t.rewrite(lambda d: d.where("id > 2")) == 3       # from version 2, not from 1
    assert [sorted(r.id for r in t.read(v).collect()) for v in t.versions()] == [[0, 1, 2, 3, 4], [2, 3, 4], [3, 4]]
    assert old.count() == 5
    assert t.expire(keep=2) == [1] and t.versions() == [2, 3]
    with pytest.raises(ValueError):
        t.read(1)


def test_a_rewrite_that_dies_or_comes_second_changes_nothing(spark):
    t = VersionedTable(spark, scratch_table(spark, "versions"))
    t.commit(spark.range(3))
    with pytest.raises(Exception):
        t.rewrite(lambda d: d.select(F.raise_error(F.lit("dies"))))
    assert t.versions() == [1] and t.read().count() == 3
    def meanwhile(d):
        assert t.rewrite(lambda e: e.where("id = 1")) == 3    # another rewrite; number 2 went with the one that died
        return d.where("id = 2")

    with pytest.raises(RuntimeError):
        t.rewrite(meanwhile)
    assert t.versions() == [1, 3] and [r.id for r in t.read().collect()] == [1]


def test_rejected_lines_are_kept(spark):
    path, target = scratch_table(spark, "lines"), scratch_table(spark, "parsed")
    lines = ['1;a b;01/31/2020 01:02:03 PM', 'x;bad id;01/31/2020 01:02:03 PM', '3;"quoted; text";01/31/2020 01:02:03 AM',
             '4;short', '5;long;01/31/2020 01:02:03 PM;more', '6;bad date;2020-01-31', '7;;']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("at", T.TimestampType())])
    clean, rejected = scan_csv_checked(spark, path, target, schema, header=False)
    assert sorted((r.id, r.t, r["at"] is None) for r in clean.collect()) == [(1, "a b", False), (3, "quoted; text", False), (7, None, True)]
    assert sorted(r.line for r in rejected.collect()) == sorted([lines[1], lines[3], lines[4], lines[5]])
    assert {r.file[:5] for r in rejected.collect()} == {"part-"}


def test_distinct_counts(spark):
    rows = [(0.0, "a", None, b"x"), (-0.0, "A", 1, b"x"), (float("nan"), None, 1, None), (float("nan"), "", 2, b""), (None, "a", None, b"y")]
    df = spark.createDataFrame(rows, "d double, s string, i int, b binary").repartition(3)
    assert distinct_counts(df, df.columns).first().asDict() == {"d": 2, "s": 3, "i": 2, "b": 3}
    assert distinct_counts(df, df.columns, include_null=True).first().asDict() == {"d": 3, "s": 4, "i": 3, "b": 4}
    assert distinct_counts(df.limit(0), df.columns).first().asDict() == {"d": 0, "s": 0, "i": 0, "b": 0}
    plan = _formatted(distinct_counts(df, df.columns))
    assert "Expand" not in plan
    many = spark.range(50_000).select((F.col("id") % 9000).alias("k"), F.col("id").cast("string").alias("u"))
    got = distinct_counts(many, ["k", "u"], approx=True).first()
    assert abs(got.k - 9000) <= 4 * SKETCH_ERROR * 9000 and abs(got.u - 50_000) <= 4 * SKETCH_ERROR * 50_000


def test_duplicate_rows(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 2]), draw.choice([None, "1", "2", ""]), draw.choice([None, 0.0, 1.5])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, `b.c` string, d double").repartition(4)
    assert duplicate_rows(df).first().duplicate_rows == len(rows) - len(set(rows))
    assert duplicate_rows(df.distinct()).first().duplicate_rows == 0
    assert duplicate_rows(df.limit(0)).first().duplicate_rows == 0
    # a value in another column, and NULL in its place, are other rows
    two = spark.createDataFrame([("x", None), (None, "x"), (None, None)], "a string, b string")
    assert duplicate_rows(two).first().duplicate_rows == 0


@pytest.mark.parametrize("descending", [True, False])
def test_dense_rank_of_all_rows(spark, descending):
    from pyspark.sql.window import Window
    df = spark.range(4000).select("id", F.when(F.col("id") % 13 != 0, (F.col("id") * 7919) % 1777).alias("v"))
    order = F.col("v").desc() if descending else F.col("v").asc()
    want = df.withColumn("rank", F.dense_rank().over(Window.orderBy(order)))
    got = dense_rank_all(df, "v", descending)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "Window" not in _formatted(got) and "SinglePartition" not in _formatted(got)
    assert dense_rank_all(df.limit(0), "v").collect() == []
