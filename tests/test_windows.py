import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.agg import quantiles
from quarry.operators.joins import attach_scalar, lookup_join
from quarry.operators.windows import rank_prefix, sequence_within_groups


def _skewed(spark):
    # group 0 holds more than half of the rows, a fifth has no group; tied dates
    return spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.col("id") % 7)
        .otherwise(0).alias("g"), (F.col("id") % 17).alias("d"), F.md5(F.col("id").cast("string")).alias("payload"))


@pytest.mark.parametrize("partitions", [None, 1, 8])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_sequence_matches_window(spark, partitions, reuse):
    df = _skewed(spark)
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = sequence_within_groups(df, ["g"], ["d", "id"], out="rn", num_partitions=partitions, lag_cols=["d"],
                                     slice_rows_log2=6)
        assert got.columns == [*df.columns, "rn", "lag_d"]
        a = sorted((tuple(r) for r in got.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    w = Window.partitionBy("g").orderBy("d", "id")
    want = df.withColumn("rn", F.row_number().over(w).cast("long")).withColumn("lag_d", F.lag("d").over(w))
    assert a == sorted((tuple(r) for r in want.collect()), key=str)


def test_rank_prefix_ties(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([9, 9, 8, 7, 7, 7, 5, 1, None])], "k int, v int")
    r = sorted((x.k, x.rank) for x in rank_prefix(df, "v", 3, "rank", ["k"]).collect())
    assert r == [(0, 1), (1, 1), (2, 3)]
    d = sorted((x.k, x.rank) for x in rank_prefix(df, "v", 3, "dense_rank", ["k"]).collect())
    assert d == [(0, 1), (1, 1), (2, 2), (3, 3), (4, 3), (5, 3)]


def test_scalar_of_several_rows_is_an_error(spark):
    df, three = spark.range(5), spark.range(3).withColumnRenamed("id", "x")
    assert {r.x for r in attach_scalar(df, three.agg(F.max("x").alias("x"))).collect()} == {2}
    assert {r.x for r in attach_scalar(df, three.where("x > 9")).collect()} == {None}
    with pytest.raises(Exception):
        attach_scalar(df, three).collect()


def test_lookup_join_spreads_null_keys(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, None, 1), (3, 9, 2), (4, 1, 2)], "id int, k int, z int")
    look = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert sorted(tuple(r) for r in lookup_join(df, look, ["k"], ["v"]).select("id", "v").collect()) == [
        (1, "a"), (2, None), (3, None), (4, "a")]
    part = lookup_join(df, look, ["k"], ["v"], needed=F.col("z") == 2)
    assert sorted(tuple(r) for r in part.select("id", "v").collect()) == [(1, None), (2, None), (3, None), (4, "a")]


@pytest.mark.parametrize("values", [[1, 2, 10, 20], [5], [3, 3, 3, 3], [None, 1, 2], list(range(101)), [0, 1e9, 1, 2, 2, 2]])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    at = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = quantiles(df, "v", at).first()
    want = df.agg(*[F.percentile("v", q).alias(n) for n, q in at.items()]).first()
    assert [got[n] for n in at] == pytest.approx([want[n] for n in at])


def test_quantiles_of_nothing(spark):
    assert tuple(quantiles(spark.createDataFrame([], "v double"), "v", {"m": 0.5}).first()) == (None,)


@pytest.mark.parametrize("partitions", [None, 1, 8])
@pytest.mark.parametrize("log2", [24, 5])
def test_sequence_by_runs_and_by_range(spark, partitions, log2):
    """Both ways to number rows, with NULLs in group and order, several group columns,
    strings and times, and a value of ``lag`` that is missing in the last row of a run."""
    df = _skewed(spark).select(
        "id", "g", F.when(F.col("id") % 4 != 0, F.concat(F.lit("s"), (F.col("id") % 3).cast("string"))).alias("h"),
        F.when(F.col("d") != 3, F.timestamp_seconds(F.col("d") * 86400)).alias("t"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("x"), "payload").repartition(6)
    got = sequence_within_groups(df, ["g", "h"], ["t", "id"], out="rn", num_partitions=partitions, lag_cols=["t", "x"],
                                 slice_rows_log2=6, run_rows_log2=log2)
    assert got.columns == [*df.columns, "rn", "lag_t", "lag_x"]
    w = Window.partitionBy("g", "h").orderBy("t", "id")
    want = df.withColumns({"rn": F.row_number().over(w).cast("long"), "lag_t": F.lag("t").over(w), "lag_x": F.lag("x").over(w)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_numbering_by_runs_writes_no_rows(spark):
    from quarry.operators.materialize import written
    before = set(written(spark))
    df = _skewed(spark)
    out = sequence_within_groups(df, ["g"], ["d", "id"], out="rn")
    made = [p for p in written(spark) if p not in before]
    assert len(made) == 1 and "payload" not in spark.read.parquet(made[0]).columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "row_number" not in plan
    assert sequence_within_groups(df.limit(0), ["g"], ["d", "id"], out="rn", lag_cols=["d"]).collect() == []
