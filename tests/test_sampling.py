import pytest
from pyspark.sql import functions as F

from quarry.operators.sampling import class_counts, first_by_hash, oversample, undersample


def _frame(spark, n_pos, n_neg):
    return spark.range(0, n_pos + n_neg).select(F.col("id").alias("key"), (F.col("id") < n_pos).alias("y"))


@pytest.mark.parametrize("n_pos,n_neg", [(30, 90), (37, 100)])
def test_exact_sizes(spark, n_pos, n_neg):
    df = _frame(spark, n_pos, n_neg)
    u = undersample(df, "y", "key")
    assert {r.y: r["count"] for r in u.groupBy("y").count().collect()} == {True: n_pos, False: n_pos}
    o = oversample(df, "y", "key")
    assert {r.y: r["count"] for r in o.groupBy("y").count().collect()} == {True: n_neg, False: n_neg}


def test_first_by_hash_equals_sort_limit(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("key"))
    got = {r.key for r in first_by_hash(df, "key", 42, 777).collect()}
    h = F.md5(F.concat(F.col("key").cast("string"), F.lit("42")))
    want = {r.key for r in df.orderBy(h, "key").limit(777).collect()}
    assert got == want


def test_partition_invariance(spark):
    df = _frame(spark, 40, 200)
    a = sorted(r.key for r in undersample(df.repartition(1), "y", "key").collect())
    b = sorted(r.key for r in undersample(df.repartition(7), "y", "key").collect())
    assert a == b


def test_three_classes_fail(spark):
    df = spark.range(0, 30).select((F.col("id") % 3).alias("y"))
    with pytest.raises(Exception):
        class_counts(df, "y").collect()


def test_null_keys_and_classes_count(spark):
    df = spark.range(0, 1000).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("key"), F.col("id").alias("x"),
        F.when(F.col("id") % 4 != 0, F.lit(True)).alias("y"))  # the second class is NULL
    assert first_by_hash(df, "key", 42, 500).count() == 500
    u = undersample(df, "y", "key")
    assert {r.y: r["count"] for r in u.groupBy("y").count().collect()} == {True: 250, None: 250}
    o = oversample(df, "y", "key")
    assert {r.y: r["count"] for r in o.groupBy("y").count().collect()} == {True: 750, None: 750}
    assert o.select("x").distinct().count() == 1000


def test_plans_read_the_table_three_times_without_joins(spark):
    import __spark_entry__ as E
    q = E.queries()
    plan = q["undersample"](spark, "/root/testdata/sf0.001")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    suite = q["sampling_suite"](spark, "/root/testdata/sf0.001")
    assert "NestedLoop" not in suite._jdf.queryExecution().executedPlan().toString()


def test_three_classes_fail_when_balancing(spark):
    df = spark.range(0, 30).select(F.col("id").alias("key"), (F.col("id") % 3).alias("y"))
    with pytest.raises(Exception):
        undersample(df, "y", "key").collect()
