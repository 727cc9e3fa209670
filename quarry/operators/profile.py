"""Table profiling and class-imbalance analysis in one pass per column.

The per-column loops of a driver program (a distinct job, a group-by job
and a top-k job per column) become ONE long ``(feature, value)`` frame of the text
columns: partial aggregation on the map side, one shuffle of the counts, then
aggregates over those. The profile takes numbers in one wide aggregate instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.functions.calendar import derive_time_features, geo_grid
from quarry.operators.agg import long_values

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Imbalance labels and their thresholds on the dominance ratio.
LABELS = [(0.9, "almost_constant"), (0.6, "strong_imbalance"), (0.3, "moderate_imbalance")]
BALANCED = "relatively_balanced"
SKIPPED = "skipped"


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, value, count)`` for every column, NULL kept as a value."""
    return (long_values(df, columns).groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def profile_table(df: DataFrame) -> DataFrame:
    """Per column: type, NULLs, NULL %; for strings and booleans distinct
    (non-NULL), top value and its share of rows (ties -> smallest value); for
    numbers mean, sample stddev and variance, min, max.

    Numbers are one wide aggregate that reads only them; strings and booleans are one
    (feature, value) frame with one shuffle of counts. Each column is read once."""
    kinds, dtypes = {f.name: f.dataType for f in df.schema.fields}, dict(df.dtypes)
    text = [c for c in df.columns if isinstance(kinds[c], (T.StringType, T.BooleanType))]
    other = [c for c in df.columns if c not in text]
    moments = {"mean": F.avg, "stddev": F.stddev_samp, "variance": F.var_samp, "min": F.min, "max": F.max}
    parts = []
    if other:
        wide = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(other):
            x = F.col(f"`{c}`").cast("double") if isinstance(kinds[c], NUMERIC) else F.lit(None).cast("double")
            wide += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}"), *[f(x).alias(f"{n}_{i}") for n, f in moments.items()]]
        rows = F.explode(F.array(*[F.struct(
            F.lit(c).alias("feature"), "rows", F.col(f"nulls_{i}").alias("nulls"), F.lit(None).cast("long").alias("distinct"),
            F.lit(None).cast("string").alias("top_value"), F.lit(None).cast("long").alias("top_count"),
            *[F.col(f"{n}_{i}").alias(n) for n in moments]) for i, c in enumerate(other)]))
        parts.append(df.agg(*wide).select(rows.alias("r")).select("r.*"))
    if text:
        counts = value_counts(df, text)
        best = F.struct(-F.col("count"), F.col("value"))
        parts.append(counts.groupBy("feature").agg(
            F.sum("count").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct"), F.min_by("value", best).alias("top_value"), F.min_by("count", best).alias("top_count"),
            *[F.max(F.lit(None).cast("double")).alias(n) for n in moments]))
    types = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(dtypes[c]))])
    return reduce(DataFrame.unionByName, parts).select(
        "feature", types[F.col("feature")].alias("dtype"), "rows", "nulls",
        F.round(F.col("nulls") / F.col("rows") * 100, 6).alias("null_pct"), "distinct",
        *[F.round(c, 4).alias(c) for c in ("mean", "stddev", "variance")], "min", "max",
        "top_value", "top_count", F.round(F.col("top_count") / F.col("rows"), 4).alias("top_ratio"))


def imbalance_frame(df: DataFrame, date_col: str | None, lat_col: str | None, lon_col: str | None,
                    grid_size: float = 0.01) -> tuple[DataFrame, list[str]]:
    """Add ``geo_grid`` and ``crime_*`` time features; returns the frame and
    the columns used only to derive them."""
    aux = []
    if lat_col and lon_col:
        df = df.withColumn("geo_grid", geo_grid(lat_col, lon_col, grid_size))
        aux += [lat_col, lon_col]
    if date_col:
        df = derive_time_features(df, date_col)
        aux.append(date_col)
    return df, aux


def _eligibility(df: DataFrame, exclude: list[str], force_numeric: list[str], aux: list[str]):
    """Reason by type (driver side, no job); distinct counts decide later."""
    plan = {}
    for f in df.schema.fields:
        t = f.dataType
        if f.name in aux:
            plan[f.name] = "used_for_derived_feature"
        elif f.name in exclude:
            plan[f.name] = "excluded"
        elif isinstance(t, (T.StringType, T.BooleanType)):
            plan[f.name] = "categorical"
        elif f.name in force_numeric and isinstance(t, INTEGRAL):
            plan[f.name] = "forced_numeric"
        elif isinstance(t, INTEGRAL):
            plan[f.name] = "low_cardinality_numeric"
        else:
            plan[f.name] = "skipped_unsupported_type"
    return plan


def imbalance_analysis(df: DataFrame, exclude: list[str], force_numeric: list[str], aux: list[str],
                       max_distinct: int = 100, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(summary, top values). NULL counts as a distinct value and can be the
    top value. Labels by the dominance ratio (top count / rows)."""
    plan = _eligibility(df, exclude, force_numeric, aux)
    cand = [c for c, r in plan.items() if r in ("categorical", "forced_numeric", "low_cardinality_numeric")]
    counts = value_counts(df, cand)
    # totals by a distributed aggregate (one row per feature, broadcast);
    # the window only keeps the top n per feature (WindowGroupLimit), so a
    # feature with millions of distinct values is never one task
    totals = counts.groupBy("feature").agg(F.sum("count").alias("rows"),
                                           F.count(F.lit(1)).alias("distinct_count"))
    w = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    ranked = (counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
              .join(F.broadcast(totals), "feature"))
    reason_map = F.create_map(*[x for c in cand for x in (F.lit(c), F.lit(plan[c]))])
    reason = (F.when(F.col("distinct_count") <= 1, F.lit("skipped_constant"))
              .when((reason_map[F.col("feature")] == "low_cardinality_numeric")
                    & (F.col("distinct_count") > max_distinct), F.lit("skipped_high_cardinality_numeric"))
              .otherwise(reason_map[F.col("feature")]))
    top = ranked.filter(F.col("rank") <= top_n).withColumn("analysis_type", reason)
    analyzed = F.col("analysis_type").isin("categorical", "forced_numeric", "low_cardinality_numeric")
    per = top.groupBy("feature", "analysis_type", "distinct_count", "rows").agg(
        F.max_by("value", F.when(F.col("rank") == 1, 1).otherwise(0)).alias("top_value"),
        F.max(F.when(F.col("rank") == 1, F.col("count"))).alias("top_count"),
        F.sum("count").alias("top_n_count"))
    label = F.lit(BALANCED)
    for thr, name in reversed(LABELS):
        label = F.when(F.col("dominance_ratio") >= thr, F.lit(name)).otherwise(label)
    # the label goes by the ratio itself, only the shown ratio is rounded
    summary_an = (per.withColumn("dominance_ratio", F.col("top_count") / F.col("rows"))
                  .withColumn("top_n_ratio", F.round(F.col("top_n_count") / F.col("rows"), 6))
                  .withColumn("imbalance_label", F.when(analyzed, label).otherwise(F.lit(SKIPPED)))
                  .withColumn("dominance_ratio", F.round("dominance_ratio", 6)))
    summary_an = summary_an.select(
        "feature", "analysis_type", "distinct_count",
        *[F.when(analyzed, F.col(c)).alias(c) for c in ("top_value", "top_count", "dominance_ratio", "top_n_ratio")],
        "imbalance_label")
    spark = df.sparkSession
    static = [(c, r) for c, r in plan.items() if c not in cand]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in summary_an.schema.fields])
    static_df = spark.createDataFrame(
        [(c, r, None, None, None, None, None, SKIPPED) for c, r in static], schema) if static else None
    summary = summary_an.unionByName(static_df) if static_df is not None else summary_an
    ranks = [name for _, name in LABELS] + [BALANCED, SKIPPED]
    order = F.array_position(F.array(*[F.lit(x) for x in ranks]), F.col("imbalance_label"))
    summary = summary.orderBy(order, F.desc_nulls_last("dominance_ratio"), "feature")   # one row per column
    values = (top.filter(analyzed)
              .select("feature", "value", "count", F.round(F.col("count") / F.col("rows"), 6).alias("ratio"),
                      F.col("rank").cast("int").alias("rank")))
    return summary, values
