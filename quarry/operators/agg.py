"""Grouped and global aggregations (single pass, partial + final hash agg)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.functions.formatting import ratio
from quarry.operators.joins import bounded_broadcast, settled


SKETCH_LOG2 = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)   # relative standard error of a HyperLogLog sketch


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def group_count(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """``count(*)`` by keys (NULL is a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, keys: list[str], predicates: dict[str, Column],
                       require_all: bool = True) -> DataFrame:
    """Counts of several predicates by key in ONE scan and ONE shuffle.

    Replaces "filter A, group; filter B, group; inner join" (two scans of the
    fact and a join). ``require_all`` reproduces the inner-join semantics:
    keys with a zero count on either side vanish."""
    out = df.groupBy(*keys).agg(*[F.count_if(p).alias(n) for n, p in predicates.items()])
    if require_all:
        out = out.filter(reduce(lambda a, b: a & b, [F.col(n) > 0 for n in predicates]))
    return out


def global_aggregate(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """One-row aggregate (stays in the plan; attach with ``attach_scalar``)."""
    return df.agg(*[c.alias(n) for n, c in aggs.items()])


def group_mean(df: DataFrame, keys: list[str], values: list[str], suffix: str = "_mean") -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(v).alias(f"{v}{suffix}") for v in values])


def group_mode(df: DataFrame, keys: list[str], value: str, out: str | None = None,
               min_share: float | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Most frequent non-NULL ``value`` per key group; ties -> smallest value.

    ``min_share`` keeps the mode only when ``count / group_total >= min_share``
    (dominant mode). ``counts`` may pass pre-aggregated
    ``(keys, value, count)`` rows so that several levels share one scan."""
    out = out or f"{value}_mode"
    if counts is None:
        counts = (df.filter(F.col(value).isNotNull())
                  .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    else:
        counts = counts.groupBy(*keys, value).agg(F.sum("_n").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), F.asc(value))
    ranked = counts.withColumn("_rn", F.row_number().over(w))
    if min_share is not None:
        ranked = ranked.withColumn("_tot", F.sum("_n").over(Window.partitionBy(*keys)))
        ranked = ranked.filter(F.col("_n") / F.col("_tot") >= F.lit(min_share))
    return ranked.filter(F.col("_rn") == 1).select(*keys, F.col(value).alias(out))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: NULL count per column."""
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_percent(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form ``(column, null_count, null_pct)`` from one aggregate."""
    cols = columns or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("null_count"))
        for i, c in enumerate(cols)]))
    return (wide.select("__rows", stack.alias("s"))
            .select("s.column", "s.null_count",
                    ratio("s.null_count", "__rows", 100.0).alias("null_pct")))


def _digest(column: Column, kind: T.DataType) -> Column:
    """128 bits of a value; NULL for NULL. Equal numbers have equal digests (0.0 and -0.0)."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        column = column + F.lit(0.0)
    return F.unhex(F.md5(column if isinstance(kind, T.BinaryType) else column.cast("string")))


def distinct_counts(df: DataFrame, columns: list[str], include_null: bool = False,
                    approx: bool = False) -> DataFrame:
    """One row: distinct count per column. ``include_null`` adds 1 when the
    column has a NULL (the ``distinct().count()`` form).

    A row gives a (column number, 128-bit digest) pair per column; equal pairs vanish in
    the task that reads them and are counted per column after one shuffle of digests.
    ``approx`` estimates from one HyperLogLog sketch per column instead, which is
    merged in any order; its relative standard error is ``SKETCH_ERROR``."""
    if approx:
        def one(c: str) -> Column:
            d = F.hll_sketch_estimate(F.hll_sketch_agg(_digest(F.col(c), df.schema[c].dataType), SKETCH_LOG2))
            return (d + F.max(F.col(c).isNull().cast("int")) if include_null else d).alias(c)
        return df.agg(*[one(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), _digest(F.col(c), df.schema[c].dataType).alias("d"))
                      for i, c in enumerate(columns)])
    seen = df.select(F.explode(pairs).alias("p")).select("p.c", "p.d")
    if not include_null:
        seen = seen.where(F.col("d").isNotNull())
    return seen.distinct().agg(*[F.count_if(F.col("c") == i).alias(c) for i, c in enumerate(columns)])


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row, NULLs in their places."""
    parts = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(*parts).alias("__h0"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("__h1")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: ``total - distinct rows`` (full-row duplicates).

    128-bit digests are counted first and only they are shuffled. Rows whose digest
    comes more than once are then compared whole, grouped where they are read, so a
    collision of digests is not counted. Eager: the repeated digests are written."""
    h0, h1 = row_digest(df)
    repeated = settled(df.select(h0, h1).groupBy("__h0", "__h1").agg(F.count(F.lit(1)).alias("__n"))
                       .where("__n > 1").select("__h0", "__h1"), "repeated")
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns], h0, h1).join(repeated, ["__h0", "__h1"], "left_semi")
    g = rows.groupBy("__h0", "__h1", *[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def heatmap_pivot(df: DataFrame, row_key: str, col_key: str, values: list | None = None) -> DataFrame:
    """``row_key x col_key`` count matrix; missing cells are 0.

    With ``values`` the columns are those values, ``null``, and ``other`` for what is
    not listed, all counted in one aggregate. Without, they are the values that occur
    (NULL as ``null``), found by one distinct aggregate over the grouped counts;
    more of them than Spark's ``spark.sql.pivotMaxValues`` are an error, never a cut."""
    if values is not None:
        c = F.col(col_key)
        return df.groupBy(row_key).agg(
            *[F.count_if(c == F.lit(v)).alias(str(v)) for v in values], F.count_if(c.isNull()).alias("null"),
            F.count_if(c.isNotNull() & ~c.isin(values)).alias("other"))
    counts = df.groupBy(row_key, col_key).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(row_key).pivot(col_key).agg(F.sum("__n")).na.fill(0)


def long_values(df: DataFrame, columns: list[str], feature: str = "feature",
                value: str = "value") -> DataFrame:
    """Stack columns into ``(feature, value)`` strings (NULLs kept), so that
    per-column statistics become ONE grouped aggregate instead of a job per
    column."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias(feature), F.col(c).cast("string").alias(value)) for c in columns]))
    return df.select(pairs.alias("__p")).select(f"__p.{feature}", f"__p.{value}")


def ordered_image(value: Column) -> Column:
    """A 64-bit integer for a double, in the same order: its exponent and mantissa
    as they stand in its 64 bits, negated for negative values. NaN comes last."""
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    # log2 may be off by one next to a power of two
    exponent = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    half = F.floor(-exponent / 2)  # 2^-e itself can leave the range of a double
    mantissa = size * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), -exponent - half)
    normal = (exponent.cast("long") + 1022) * (1 << 52) + (mantissa * float(1 << 52)).cast("long")
    tiny = (size * (2.0 ** 537) * (2.0 ** 537)).cast("long")
    image = (F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), F.lit((1 << 63) - 2))
             .when(size < 2.0 ** -1022, tiny).otherwise(normal))
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(value < 0, -image).otherwise(image)


def count_quantiles(counts: DataFrame, at: dict[str, float], features: int) -> DataFrame:
    """(feature, name, quantile) of a written table (feature, x, n) of how often
    values occur, interpolated as ``percentile`` does; ``features`` bounds their number.

    A quantile q lies at position q * (n - 1) of the ordered values. Positions are found
    by radix selection on the values' 64-bit images: counts per 16-bit prefix, then inside
    the prefix that holds the position per further 16 bits, four times. No range of
    values is ever ordered: a window sees at most 2^16 counts. Eager: a small job for each
    of the four, whose positions (two for each quantile and feature) are collected."""
    spark = counts.sparkSession
    bound = features * 2 * len(at)
    names = spark.createDataFrame([(n, float(q)) for n, q in at.items()], "name string, q double")
    totals = counts.groupBy("feature").agg(F.sum("n").alias("all"))
    place = F.col("q") * (F.col("all") - 1)
    targets = (totals.join(bounded_broadcast(names, len(at)))
               .select("feature", "name", (place - F.floor(place)).alias("part"),
                       F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor(place).alias("pos")),
                                         F.struct(F.lit(1).alias("side"), F.ceil(place).alias("pos")))).alias("t"))
               .select("feature", "name", "part", "t.side", F.col("t.pos").cast("long").alias("pos")))
    rows = counts.select("feature", "x", "n", ordered_image(F.col("x")).alias("image"))
    before = Window.partitionBy("feature", "name", "side").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    for shift in (48, 32, 16, 0):
        inside, keys = rows, ["feature"]
        if shift < 48:
            inside = rows.withColumn("prefix", F.shiftright("image", shift + 16))
            keys = ["feature", "prefix"]
            inside = inside.join(bounded_broadcast(targets.select(*keys).distinct(), bound), keys, "left_semi")
        cells = inside.groupBy(*keys, F.shiftright("image", shift).alias("cell")).agg(F.sum("n").alias("n"), F.max("x").alias("x"))
        found = (cells.join(bounded_broadcast(targets, bound), keys)
                 .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
                 .where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + F.col("n"))))
        found = found.select("feature", "name", "part", "side", (F.col("pos") - F.col("start")).alias("pos"),
                             F.col("cell").alias("prefix"), "x").collect()   # a row per position
        schema = "feature string, name string, part double, side int, pos long, prefix long, x double"
        ends = spark.createDataFrame(found, schema)
        targets = ends.drop("x")
    ends = ends.groupBy("feature", "name", "part").agg(F.max(F.when(F.col("side") == 0, F.col("x"))).alias("low"),
                                                          F.max(F.when(F.col("side") == 1, F.col("x"))).alias("high"))
    # equal neighbours as they are: infinities have no difference
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part"))
    return ends.select("feature", "name", value.alias("quantile"))


def quantiles(df: DataFrame, value: str, at: dict[str, float]) -> DataFrame:
    """One row of exact interpolated quantiles (as ``percentile``) of the non-NULL
    values, without gathering them (``count_quantiles``). Eager: the counts per
    distinct value are written."""
    counts = settled(df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x"))
                     .agg(F.count(F.lit(1)).alias("n")).select(F.lit(value).alias("feature"), "x", "n"), "value-counts")
    found = count_quantiles(counts, at, 1)
    return found.agg(*[F.max(F.when(F.col("name") == n, F.col("quantile"))).alias(n) for n in at])
