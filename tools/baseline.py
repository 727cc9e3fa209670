"""Time the plan shapes of the surveyed jobs next to this engine's keys.

The shapes are written from the survey's description of what each job does
(two scans and a join for a ratio, one job per column, a window per group over
the fact, one table copy per stage ...), over the same bindings, so both sides
compute the same numbers. Prints seconds per key and the ratio.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry.plans.bindings import incidents  # noqa: E402
from quarry.plans.declared import ORDER_KEYS, _grouped  # noqa: E402
from quarry.plans.preprocess import raw, stage_features  # noqa: E402
from quarry.plans.stats import PROFILE_COLS  # noqa: E402


def ratio_by_district(spark, sf):
    df = incidents(spark, sf)
    a = df.filter(F.col("domestic")).groupBy("district").count().withColumnRenamed("count", "a")
    b = df.filter(~F.col("domestic")).groupBy("district").count().withColumnRenamed("count", "b")
    return a.join(b, "district").withColumn("r", F.col("a") / F.col("b"))


def arrest_rank(spark, sf):
    df = incidents(spark, sf)
    total = df.groupBy("ward").count().withColumnRenamed("count", "t")
    hits = df.filter("arrest").groupBy("ward").count().withColumnRenamed("count", "h")
    rated = total.join(hits, "ward").withColumn("rate", F.col("h") / F.col("t"))
    return rated.withColumn("rank", F.dense_rank().over(W.orderBy(F.desc("rate")))).limit(15)


def top_type(spark, sf):
    g = incidents(spark, sf).groupBy("district", "primary_type").count()
    return g.withColumn("rank", F.rank().over(W.partitionBy("district").orderBy(F.desc("count")))).filter("rank = 1")


def row_number(spark, sf):
    df = _grouped(spark, sf, "district")
    return df.withColumn("n", F.row_number().over(W.partitionBy("district").orderBy("incident_date", *ORDER_KEYS)))


def interval(spark, sf):
    df = _grouped(spark, sf, "district")
    return df.withColumn("l", F.lag("incident_date").over(W.partitionBy("district").orderBy("incident_date", *ORDER_KEYS)))


def top_streets(spark, sf):
    df = stage_features(spark, sf)
    return df.groupBy("street_name").count().orderBy(F.desc("count")).limit(10)


def profile_by_column(spark, sf):
    df = raw(spark, sf).select(*PROFILE_COLS)
    rows, out = df.count(), []
    for c in PROFILE_COLS:
        nulls = df.filter(F.col(c).isNull()).count()
        distinct = df.select(F.countDistinct(c)).first()[0]
        top = df.groupBy(c).count().orderBy(F.desc("count")).first()
        out.append((c, rows, nulls, distinct, top["count"]))
    return spark.createDataFrame(out, "c string, rows long, nulls long, distinct_ long, top long")


def top_values_by_column(spark, sf):
    df = raw(spark, sf)
    rows, out = df.count(), []
    for c in ["block", "primary_type", "description", "location_description", "fbi_code"]:
        top = df.groupBy(c).count().orderBy(F.desc("count")).first()
        out.append((c, top["count"] / rows))
    return spark.createDataFrame(out, "c string, ratio double")


SHAPES = {
    "q3_d_ratio_by_district": ratio_by_district,
    "q5_d_arrest_ratio_by_ward": arrest_rank,
    "q5_j_top_type_per_district": top_type,
    "q4_j_top_streets": top_streets,
    "bq21_row_number_by_date": row_number,
    "bq23_lag_diff": interval,
    "profile_table": profile_by_column,
    "top_value_ratio": top_values_by_column,
}


def seconds(fn, spark, sf, runs: int = 3) -> float:
    times = []
    for _ in range(runs + 1):  # the first run warms up
        t = time.perf_counter()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t)
    return statistics.median(times[1:])


def main() -> None:
    from quarry.plans import registry
    from quarry.session import local_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cpus=int(os.environ.get("BENCH_CPUS", "8")), app="quarry-baseline")
    queries = registry.queries()
    print("| key | plan shape of the surveyed job, s | this engine, s | ratio |\n|---|---|---|---|")
    for key, shape in SHAPES.items():
        base, own = seconds(shape, spark, sf), seconds(queries[key], spark, sf)
        print(f"| `{key}` | {base:.2f} | {own:.2f} | {own / base:.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
