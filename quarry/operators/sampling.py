"""Deterministic, partition-independent sampling and class re-balancing.

Every choice is a function of ``md5(key || seed)``, so results do not depend
on partitioning, task retries or executor loss (``DataFrame.sample`` does).
Rows with a NULL key are hashed by all their columns instead, so they take part
like any other row and do not share one hash.

Exact "first n rows in hash order" without a global sort in one task
(``first_by_hash``):
1. count rows by a 4-hex-digit prefix of the hash (at most 65,536 groups,
   partial aggregation on the map side);
2. a running sum over those <= 65,536 rows finds the prefix where the n-th
   row falls and how many rows of it are needed (a scalar subquery);
3. rows with a smaller prefix are kept by a filter, rows of the cut prefix
   by ``row_number`` inside that prefix only.
The result equals ``ORDER BY hash, key LIMIT n``. Re-balancing counts (class,
prefix) once and takes the class sizes and the cut from those counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.joins import attach_scalar

PREFIX_HEX = 4   # 16**4 = 65,536 prefix groups


def key_hash(key: str, seed: int, columns: list[str]) -> Column:
    own = F.coalesce(F.col(key).cast("string"),
                     F.concat(F.lit("<null>"), F.xxhash64(*columns).cast("string")))
    return F.md5(F.concat(own, F.lit(str(seed))))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Keyed Bernoulli sample: keep rows whose hash (first 8 hex digits as a
    fraction of 16**8) is below ``fraction``. Same rows on any cluster."""
    threshold = format(min(int(fraction * 16 ** 8), 16 ** 8 - 1), "08x") if fraction < 1 else "g"
    return df.filter(F.substring(key_hash(key, seed, df.columns), 1, 8) < F.lit(threshold))


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    h = df.withColumn("__h", key_hash(key, seed, df.columns))
    return h.withColumn("__p", F.substring("__h", 1, PREFIX_HEX))


def _cut(cells: DataFrame, need: Column) -> DataFrame:
    """One row (cut, rest): the prefix in which the ``need``-th row falls and
    the rows needed from it. ``cells`` has one row (__p, __c) per prefix; no cut
    (NULL) if there are fewer rows."""
    # at most 65,536 rows: a single ordered pass is bounded
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = cells.withColumn("__run", F.sum("__c").over(w)).filter(F.col("__run") >= need)
    return run.agg(F.min_by("__p", "__p").alias("__cut"),
                   F.min_by(need - (F.col("__run") - F.col("__c")), "__p").alias("__rest"))


def _at_cut(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The first ``__rest`` rows of the cut prefix."""
    wr = Window.partitionBy("__p").orderBy("__h", key, F.xxhash64(*columns))
    at = rows.filter(F.col("__p") == F.col("__cut")).withColumn("__rn", F.row_number().over(wr))
    return at.filter(F.col("__rn") <= F.col("__rest"))


def first_by_hash(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` in (hash, key) order."""
    h = _hashed(df, key, seed)
    cells = h.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    j = attach_scalar(h, _cut(cells, F.lit(n)))
    before = j.filter(F.col("__cut").isNull() | (F.col("__p") < F.col("__cut")))
    return before.select(*df.columns).unionByName(_at_cut(j, key, df.columns).select(*df.columns))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """``(target, count, role, n_classes)``: role 'minority' for the smaller
    class (ties -> smaller value), 'majority' for the other. Fails at run
    time unless there are exactly two classes (NULL counts as a class)."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    # two rows: a global window is bounded
    w = Window.orderBy(F.asc("count"), F.asc_nulls_first(target))
    c = c.withColumn("__r", F.row_number().over(w)).withColumn("n_classes", F.count(F.lit(1)).over(Window.partitionBy()))
    role = F.when(F.col("n_classes") != 2, F.raise_error(F.lit(f"target '{target}' must have exactly 2 classes"))) \
        .when(F.col("__r") == 1, F.lit("minority")).otherwise(F.lit("majority"))
    return c.withColumn("role", role).drop("__r")


def _balanced(df: DataFrame, target: str, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Hashed rows with ``__minority``, ``__n_min``, ``__n_maj``; the (class,
    prefix) counts with the same columns. One scan feeds all counts."""
    rows = _hashed(df, key, seed)
    cells = rows.groupBy(target, "__p").agg(F.count(F.lit(1)).alias("__c"))
    classes = cells.groupBy(target).agg(F.sum("__c").alias("__n"))
    size = F.struct("__n", F.col(target).isNotNull(), F.col(target).alias("__value"))
    sizes = classes.agg(F.count(F.lit(1)).alias("__classes"), F.min(size).alias("__least"), F.sum("__n").alias("__all"))
    wrong = F.raise_error(F.lit(f"target '{target}' must have exactly 2 classes"))
    sizes = sizes.select(
        F.when(F.col("__classes") != 2, wrong.cast("long")).otherwise(F.col("__least.__n")).alias("__n_min"),
        (F.col("__all") - F.col("__least.__n")).alias("__n_maj"), F.col("__least.__value").alias("__value"))

    def marked(x: DataFrame) -> DataFrame:
        return attach_scalar(x, sizes).withColumn("__minority", F.col(target).eqNullSafe(F.col("__value"))).drop("__value")

    return marked(rows), marked(cells)


def undersample(df: DataFrame, target: str, key: str, seed: int = 42) -> DataFrame:
    """All minority rows + exactly ``n_minority`` majority rows (first in
    hash order)."""
    rows, cells = _balanced(df, target, key, seed)
    majority = cells.filter(~F.col("__minority"))
    j = attach_scalar(rows, _cut(majority, F.col("__n_min")))
    kept = j.filter(F.col("__minority") | F.col("__cut").isNull() | (F.col("__p") < F.col("__cut")))
    at = _at_cut(j.filter(~F.col("__minority")), key, df.columns)
    return kept.select(*df.columns).unionByName(at.select(*df.columns))


def oversample(df: DataFrame, target: str, key: str, seed: int = 42) -> DataFrame:
    """All majority rows + minority rows replicated to exactly
    ``n_majority``: every minority row ``floor(N/n)`` times (``explode``),
    plus one more copy of the first ``N mod n`` rows in hash order."""
    rows, cells = _balanced(df, target, key, seed)
    rest = F.col("__n_maj") % F.col("__n_min")
    minority = cells.filter(F.col("__minority"))
    j = attach_scalar(rows, _cut(minority.filter(rest > 0), rest))
    times = F.when(F.col("__minority"), F.floor(F.col("__n_maj") / F.col("__n_min"))
                   + F.when(F.col("__p") < F.col("__cut"), 1).otherwise(0)).otherwise(F.lit(1))
    copies = j.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long"))))
    extra = _at_cut(j.filter(F.col("__minority")), key, df.columns)
    return copies.select(*df.columns).unionByName(extra.select(*df.columns))


def sampling_report(before: DataFrame, after: DataFrame, target: str) -> DataFrame:
    """Per class: before, after, delta, after/before ratio, change %."""
    both = (before.select(target, F.lit(1).alias("__b"), F.lit(0).alias("__a"))
            .unionByName(after.select(target, F.lit(0).alias("__b"), F.lit(1).alias("__a"))))
    counts = both.groupBy(target).agg(F.sum("__b").cast("long").alias("before"), F.sum("__a").cast("long").alias("after"))
    return (counts
            .withColumn("delta", F.col("after") - F.col("before"))
            .withColumn("ratio", F.round(F.try_divide("after", "before"), 6))
            .withColumn("change_pct", F.round(F.try_divide(F.col("after") - F.col("before"), F.col("before")) * 100, 4)))
