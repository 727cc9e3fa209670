"""Imputers: hierarchical mode, dominant mode, parent lookup, hierarchical
mean, sentinels.

Each imputer is a lookup (``*_lookup(s)``, built from counts or sums) and a fill
that streams rows past the lookups, so that a chain of imputers can build all
its lookups from one table and fill in one pass.

Scale design (same results as joining every lookup to every row):
* statistics are computed from ONE aggregate at the finest level, written once;
  coarser levels are sums of the finer counts (no re-scan per level);
* lookups are written before they are used (``settled``; building them is eager), so
  the planner broadcasts them by their file size while that is small;
* a lookup beyond the broadcast threshold meets only the keys and numbers of the rows
  that need a value (``lookup_join`` on a numbered table), and no payload moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.agg import group_mode
from quarry.operators.joins import attach_scalar, lookup_join, settled


def missing(c: str, zero_is_missing: bool = False) -> Column:
    m = F.col(c).isNull()
    return (m | (F.col(c) == 0)) if zero_is_missing else m


def mode_lookups(df: DataFrame, target: str, levels: list[list[str]]) -> list[DataFrame]:
    """The mode of ``target`` per group of each level, as ``__fill0``, ... One
    aggregate at the finest level feeds all of them."""
    finest = levels[0]
    for lv in levels[1:]:
        if not set(lv) <= set(finest):
            raise ValueError("levels must be nested: finest first")
    counts = settled(df.filter(F.col(target).isNotNull())
                     .groupBy(*finest, target).agg(F.count(F.lit(1)).alias("_n")), "mode-counts")
    return [settled(group_mode(None, keys, target, out=f"__fill{i}", counts=counts), f"mode-{i}")
            for i, keys in enumerate(levels)]


def fill_mode(df: DataFrame, target: str, levels: list[list[str]], lookups: list[DataFrame]) -> DataFrame:
    out = df
    for i, (keys, lookup) in enumerate(zip(levels, lookups)):
        out = lookup_join(out, lookup, keys, [f"__fill{i}"], needed=F.col(target).isNull())
    fill = F.coalesce(target, *[f"__fill{i}" for i in range(len(levels))]).cast(df.schema[target].dataType)
    return out.withColumn(target, fill).select(*df.columns)


def impute_mode(df: DataFrame, target: str, levels: list[list[str]]) -> DataFrame:
    """Fill NULL ``target`` with the mode of ``target`` at the first level
    (list of key columns, finest first) whose group has a non-NULL value.
    Levels must be nested (each one a subset of the previous). NULL keys
    never match. Mode ties go to the smallest value."""
    return fill_mode(df, target, levels, mode_lookups(df, target, levels))


def impute_mode_audit(df: DataFrame, target: str, levels: list[list[str]],
                      row_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``impute_mode`` plus an audit: a row per input row with its value and
    status 'original', 'imputed' or 'missing'."""
    # the flag travels with each row through the imputation: no join back on
    # row keys (which need not be unique), no extra shuffle
    filled = impute_mode(df.withColumn("__was_null", F.col(target).isNull()), target, levels)
    audit = filled.select(*row_keys, F.col(target).alias("value"),
                          F.when(~F.col("__was_null"), "original")
                           .when(F.col(target).isNotNull(), "imputed").otherwise("missing").alias("status"))
    return filled.drop("__was_null"), audit


def dominant_lookup(df: DataFrame, target: str, keys: list[str], min_share: float = 0.8) -> DataFrame:
    return settled(group_mode(df, keys, target, out="__dom", min_share=min_share), "dominant")


def fill_dominant(df: DataFrame, target: str, keys: list[str], lookup: DataFrame, default: str | None) -> DataFrame:
    out = lookup_join(df, lookup, keys, ["__dom"], needed=F.col(target).isNull())
    values = [F.col(target), F.col("__dom"), *([F.lit(default)] if default is not None else [])]
    return out.withColumn(target, F.coalesce(*values)).select(*df.columns)


def impute_dominant_mode(df: DataFrame, target: str, keys: list[str], min_share: float = 0.8,
                         default: str | None = "Unknown") -> DataFrame:
    """NULL ``target`` -> mode by ``keys`` if its share of the group is at
    least ``min_share``, else ``default``."""
    return fill_dominant(df, target, keys, dominant_lookup(df, target, keys, min_share), default)


def parent_lookup(df: DataFrame, target: str, parent: str, zero_is_missing: bool = True) -> DataFrame:
    return settled(group_mode(df.filter(~missing(target, zero_is_missing)), [parent], target, out="__par"), "parent")


def fill_parent(df: DataFrame, target: str, parent: str, lookup: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    needs = F.coalesce(missing(target, zero_is_missing), F.lit(True))
    out = lookup_join(df, lookup, [parent], ["__par"], needed=needs)
    fill = F.when(needs, F.col("__par")).otherwise(F.col(target)).cast(df.schema[target].dataType)
    return out.withColumn(target, fill).select(*df.columns)


def impute_from_parent(df: DataFrame, target: str, parent: str, zero_is_missing: bool = True) -> DataFrame:
    """Missing ``target`` (NULL, or 0 when ``zero_is_missing``) -> the value
    of ``target`` for the same ``parent`` (deterministic: most frequent,
    ties -> smallest; the source rule takes an arbitrary one)."""
    return fill_parent(df, target, parent, parent_lookup(df, target, parent, zero_is_missing), zero_is_missing)


def mean_lookups(df: DataFrame, values: list[str], levels: list[str],
                 decimal_scale: int | None = None) -> tuple[list[DataFrame], DataFrame]:
    """Means over rows with ALL values present: per key of each of ``levels``
    (NULL and 0 excluded), and over all as one row. One scan sums by all levels at
    once; ``decimal_scale`` sums in DECIMAL(38, scale), which is exact whatever the
    order of the partitions."""
    base = df.filter(reduce(lambda a, b: a & b, [F.col(v).isNotNull() for v in values]))
    kind = f"decimal(38,{decimal_scale})" if decimal_scale else "double"
    sums = settled(base.groupBy(*levels).agg(*[F.sum(F.col(v).cast(kind)).alias(f"__s_{v}") for v in values],
                                             F.count(F.lit(1)).alias("__n")), "mean-sums")

    def means(tag: str) -> list[Column]:
        return [F.try_divide(F.sum(f"__s_{v}").cast("double"), F.sum("__n").cast("double")).alias(f"__m{tag}_{v}") for v in values]

    lookups = [settled(sums.filter(F.col(key).isNotNull() & (F.col(key) != 0)).groupBy(key).agg(*means(str(i))), f"mean-{i}")
               for i, key in enumerate(levels)]
    return lookups, sums.agg(*means("g"))


def fill_mean(df: DataFrame, values: list[str], levels: list[str], lookups: list[DataFrame], overall: DataFrame) -> DataFrame:
    needs = reduce(lambda a, b: a | b, [F.col(v).isNull() for v in values])
    out = df
    for i, (key, lookup) in enumerate(zip(levels, lookups)):
        out = lookup_join(out, lookup, [key], [f"__m{i}_{v}" for v in values], needed=needs)
    out = attach_scalar(out, overall)
    for v in values:
        out = out.withColumn(v, F.coalesce(v, *[f"__m{i}_{v}" for i in range(len(levels))], f"__mg_{v}"))
    return out.select(*df.columns)


def impute_mean_hierarchy(df: DataFrame, values: list[str], levels: list[str],
                          decimal_scale: int | None = None) -> DataFrame:
    """NULL ``values`` -> mean over rows with ALL values present, by the first
    of ``levels`` (single key columns, tried in order; NULL and 0 keys
    excluded) that has a mean, else the global mean (a scalar subquery)."""
    return fill_mean(df, values, levels, *mean_lookups(df, values, levels, decimal_scale))


def sentinel_fill(df: DataFrame, columns: list[str], sentinel: int = -1) -> DataFrame:
    """NULL or 0 -> ``sentinel``."""
    return df.withColumns({c: F.when(missing(c, True), F.lit(sentinel)).otherwise(F.col(c))
                           .cast(df.schema[c].dataType) for c in columns})
