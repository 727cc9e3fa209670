"""Correlation, scaling, PCA and FAMD on Spark.

All fitting runs as distributed aggregates: one Gram aggregate (``gram``) for
correlation, z-scores and PCA, one grouped count of how levels meet for FAMD. Only
the d x d matrix and its eigen-decomposition are on the driver (d = number of
features, small and checked). Nothing row-sized goes there.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.operators.agg import count_quantiles
from quarry.operators.gram import MAX_FEATURES, Gram, components, gram
from quarry.operators.joins import settled

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_features(df: DataFrame, exclude: list[str] | None = None, drop_na: bool = True) -> tuple[DataFrame, list[str]]:
    """Numeric columns plus booleans cast to double (except ``exclude``);
    at least two features; rows with a NULL feature dropped."""
    exclude = exclude or []
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]
    bools = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType) and f.name not in exclude]
    feats = num + bools
    if len(feats) < 2:
        raise ValueError("at least two numeric / boolean features are needed")
    if len(feats) > MAX_FEATURES:
        raise ValueError(f"too many features for a driver-side eigen-decomposition ({len(feats)})")
    out = df.select(*[F.col(c).cast("double").alias(c) for c in feats], *[c for c in exclude if c in df.columns])
    return (out.na.drop(subset=feats) if drop_na else out), feats


def correlation_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pearson matrix in long form ``(col_a, col_b, r)``, rows with any NULL in
    ``columns`` skipped; r is NULL against a constant column. All pairs come from
    one Gram aggregate (eager)."""
    if len(columns) < 2:
        raise ValueError("at least two numeric columns are needed")
    r = gram(df, columns).correlation
    cells = [(a, b, 1.0 if i == j else _float(r[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "col_a string, col_b string, r double").withColumn("r", F.round("r", digits))


def high_correlations(corr: DataFrame, columns: list[str], threshold: float = 0.9) -> DataFrame:
    """Pairs ``i < j`` (column order) with ``|r| > threshold``."""
    order = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    return corr.filter((order[F.col("col_a")] < order[F.col("col_b")]) & (F.abs("r") > threshold))


def z_scores(features: list[str], moments: Gram) -> list[Column]:
    """Each feature less its mean, by its sample standard deviation; 0 for a constant one."""
    return [(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) if s else F.lit(0.0)
            for c, m, s in zip(features, moments.mean, moments.std)]


def standard_scale(df: DataFrame, features: list[str], keep: list[str], prefix: str = "z_") -> DataFrame:
    """z-scores (mean-centred, sample std) of the rows without NULL in ``features``.
    Eager: the moments are one Gram aggregate; the scores are plain column arithmetic."""
    z = z_scores(features, gram(df, features))
    return df.na.drop(subset=features).select(*keep, *[x.alias(f"{prefix}{c}") for c, x in zip(features, z)])


def pca(df: DataFrame, features: list[str], k: int, keep: list[str] | None = None):
    """PCA of the z-scores with ``k = min(k, d)``. Returns (variance frame
    (pc, explained_ratio, cumulative_ratio), loadings frame (pc, feature,
    weight), scores frame (keep + PC1..PCk)).

    Eager: one Gram aggregate gives means, deviations and the matrix whose
    eigenvectors are the components; only the scores read the rows again."""
    spark = df.sparkSession
    keep = keep or []
    k = min(k, len(features))
    moments = gram(df, features)
    if moments.rows < 2:
        raise ValueError("at least two rows without NULL are needed")
    values, vectors = components(moments.of_scores)
    ratios = values / (values.sum() or 1.0)
    variance = spark.createDataFrame([(f"PC{j + 1}", float(ratios[j]), float(ratios[:j + 1].sum())) for j in range(k)],
                                     "pc string, explained_ratio double, cumulative_ratio double")
    loadings = spark.createDataFrame([(f"PC{j + 1}", f, float(vectors[i, j])) for j in range(k) for i, f in enumerate(features)],
                                     "pc string, feature string, weight double")
    z = z_scores(features, moments)
    scores = df.na.drop(subset=features).select(*keep, *[_weighted(z, vectors[:, j]).alias(f"PC{j + 1}") for j in range(k)])
    return variance, loadings, scores


def pca_spectrum(df: DataFrame, features: list[str], powers: int = 4) -> DataFrame:
    """(power, total): sums of powers of the eigenvalues of the correlation matrix.
    The first is the total inertia (the number of features that vary); all of them
    are traces of powers of the matrix, so they check a decomposition without repeating it."""
    values, _ = components(gram(df, features).of_scores)
    return df.sparkSession.createDataFrame([(p, float((values ** p).sum())) for p in range(1, powers + 1)], "power int, total double")


def projected_variance(df: DataFrame, features: list[str], loadings: dict[str, list[float]]) -> DataFrame:
    """(axis, variance, inertia_share) of the z-scores along given axes, from the
    Gram aggregate alone: a loading vector w has variance w' R w."""
    r = gram(df, features).of_scores
    inertia = float(np.trace(r)) or 1.0
    out = [(name, float(np.array(w) @ r @ np.array(w))) for name, w in loadings.items()]
    return df.sparkSession.createDataFrame([(n, v, v / inertia) for n, v in out], "axis string, variance double, inertia_share double")


def _weighted(columns: list[Column], weights) -> Column:
    return reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(columns, weights)], F.lit(0.0))


OTHER, UNKNOWN = "OTHER", "Unknown"


def famd_design(df: DataFrame, numeric: list[str], categorical: list[str], top_n: int = 20) -> dict:
    """What FAMD needs to know of the columns: ``rows``; per numeric column
    (median, mean, population std) after NULL -> median; per categorical column
    its levels with their proportions, after NULL -> 'Unknown' and values outside
    the ``top_n`` most frequent (ties by value) -> 'OTHER'.

    One scan counts the values of all columns and writes the counts; exact medians,
    moments and levels come from those. At most ``top_n`` levels per column and one row
    per numeric column reach the driver."""
    entries = [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("string").alias("value"), F.col(c).cast("double").alias("x"))
               for c in numeric]
    entries += [F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value"),
                         F.lit(None).cast("double").alias("x")) for c in categorical]
    counts = settled(df.select(F.explode(F.array(*entries)).alias("e")).groupBy("e.feature", "e.value", "e.x")
                     .agg(F.count(F.lit(1)).alias("n")), "famd-counts")
    design: dict = {"rows": 0, "numeric": {}, "categorical": {c: {} for c in categorical}}
    if numeric:
        numbers = counts.where(F.col("feature").isin(numeric))
        medians = count_quantiles(numbers.where("x is not null"), {"median": 0.5}, len(numeric)).select(
            "feature", F.col("quantile").alias("median"))
        off = F.coalesce(F.col("x") - F.col("median"), F.lit(0.0))   # NULL counts as the median
        moments = (numbers.join(F.broadcast(medians), "feature", "left").groupBy("feature").agg(   # a row per numeric column
            F.first("median").alias("median"), F.sum("n").alias("rows"), F.sum(off * F.col("n")).alias("s1"),
            F.sum(off * off * F.col("n")).alias("s2")).collect())
        by = {r["feature"]: r for r in moments}
        for c in numeric:
            r = by.get(c)
            if r is None or r["median"] is None:
                design["numeric"][c] = (None, None, None)
            else:
                mean = r["s1"] / r["rows"]
                design["numeric"][c] = (r["median"], r["median"] + mean, math.sqrt(max(0.0, r["s2"] / r["rows"] - mean * mean)))
            design["rows"] = r["rows"] if r else 0
    if categorical:
        words = counts.where(F.col("feature").isin(categorical)).select("feature", "value", "n")
        w = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
        top = words.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top_n).orderBy("feature", "r").collect()
        rows = words.where(F.col("feature") == categorical[0]).agg(F.sum("n")).first()[0] or 0
        design["rows"] = rows
        for r in top:
            design["categorical"][r["feature"]][r["value"]] = r["n"] / rows
        for levels in design["categorical"].values():
            rest = 1 - sum(levels.values())
            if rest > 0.5 / max(1, rows):
                levels[OTHER] = levels.get(OTHER, 0.0) + rest
    return design


def design_frame(df: DataFrame, design: dict) -> DataFrame:
    """The design in long form: (variable, level, proportion, median, mean, std)."""
    out = [(c, None, None, *map(_float, v)) for c, v in design["numeric"].items()]
    out += [(c, level, p, None, None, None) for c, levels in design["categorical"].items() for level, p in levels.items()]
    return df.sparkSession.createDataFrame(
        out, "variable string, level string, proportion double, median double, mean double, std double")


def _float(x):
    return None if x is None or math.isnan(x) else float(x)


def burt(df: DataFrame, z: dict[str, Column], levels: dict[str, Column]) -> list:
    """Rows (a, level_a, b, level_b, n, s_0, ..., p_0_0, ...) of one grouped aggregate: how
    often two levels meet, for each two categorical variables (a variable with itself
    gives its level counts), with the sums of the numeric columns there; and one row
    (a is NULL) over all rows with the sums of products of the numeric columns.

    As many rows as pairs of levels at most, combined before the shuffle; all are collected."""
    names = list(levels)
    cell = "struct<a:string,level_a:string,b:string,level_b:string>"
    cells = [F.lit(None).cast(cell)]
    for i, a in enumerate(names):
        for b in names[i:]:
            cells.append(F.struct(F.lit(a).alias("a"), F.col(f"__l_{a}").alias("level_a"), F.lit(b).alias("b"),
                                  F.col(f"__l_{b}").alias("level_b")).cast(cell))
    given = df.select(*[c.alias(f"__z{i}") for i, c in enumerate(z.values())], *[c.alias(f"__l_{n}") for n, c in levels.items()])
    long = given.withColumn("__c", F.explode(F.array(*cells)))
    everything = F.col("__c").isNull()
    products = [F.sum(F.when(everything, F.col(f"__z{i}") * F.col(f"__z{j}"))).alias(f"p_{i}_{j}")
                for i in range(len(z)) for j in range(i, len(z))]
    return (long.groupBy("__c").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"__z{i}").alias(f"s_{i}") for i in range(len(z))], *products)
            .select("__c.*", "*").drop("__c").collect())


def famd(df: DataFrame, numeric: list[str], categorical: list[str], k: int, top_n: int = 20,
         keep: list[str] | None = None, design: dict | None = None):
    """Factor analysis of mixed data (Pagès 2004) from a Burt table.

    numerics: NULL -> median (exact), z-score with population std (0 for a
    constant column); categoricals: one indicator per level of ``famd_design``
    scaled ``(I - p) / sqrt(p)``. PCA of that matrix with
    ``min(k, columns, rows - 1)`` components. The contribution of a variable to a
    component is the sum of squared loadings of its columns; its coordinate is
    the contribution times the component's inertia (squared correlation or
    correlation ratio). Returns (variance (component, explained, cumulative),
    contributions (component, variable, contribution, coordinate), row
    coordinates (keep + Dim1..Dimk)).

    Eager, with two scans: one counts values (``famd_design``), one counts how
    levels meet (``burt``). The cross products of all columns follow from those counts;
    no row ever becomes a vector of indicators, and row coordinates are sums of a
    weight per level."""
    spark = df.sparkSession
    keep = keep or []
    design = design or famd_design(df, numeric, categorical, top_n)
    z, owner, inertia = {}, [], 0.0
    for c in numeric:
        med, mean, sd = design["numeric"][c]
        if med is None:
            raise ValueError(f"column {c!r} has no value")
        z[c] = (F.coalesce(F.col(c).cast("double"), F.lit(med)) - F.lit(mean)) / F.lit(sd or 1.0)
        owner.append(c)
        inertia += 1.0 if sd else 0.0
    value, place = {}, {}
    for c in categorical:
        levels = list(design["categorical"][c])
        known = [v for v in levels if v != OTHER]
        own = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
        value[c] = F.when(own.isin(known), own).otherwise(F.lit(OTHER))
        for v in levels:
            place[c, v] = len(owner)
            owner.append(c)
        inertia += len(levels) - 1
    if len(owner) > MAX_FEATURES:
        raise ValueError(f"too many columns for a driver-side eigen-decomposition ({len(owner)})")
    cells = burt(df, z, value)
    d, p = len(owner), len(numeric)
    whole = next((r for r in cells if r["a"] is None), None)
    n = whole["n"] if whole else 0
    if not n:
        raise ValueError("no rows")
    share = np.ones(d)   # proportions of the levels
    for r in cells:
        if r["a"] is not None and r["a"] == r["b"]:
            share[place[r["a"], r["level_a"]]] = r["n"] / n
    sums = np.array([whole[f"s_{i}"] for i in range(p)])
    products = np.zeros((d, d))
    for i in range(p):
        for j in range(i, p):
            products[i, j] = whole[f"p_{i}_{j}"] - sums[i] * sums[j] / n
    # levels that never meet have no row: their count is 0
    first = {c: i for i, c in enumerate(categorical)}
    for (a, la), i in place.items():
        for (b, lb), j in place.items():
            if first[a] <= first[b]:
                products[i, j] = -n * share[i] * share[j] / math.sqrt(share[i] * share[j])
    for r in cells:
        if r["a"] is not None:
            i, j = place[r["a"], r["level_a"]], place[r["b"], r["level_b"]]
            products[i, j] = (r["n"] - n * share[i] * share[j]) / math.sqrt(share[i] * share[j])
            if i == j:
                for m in range(p):
                    products[m, i] = (r[f"s_{m}"] - share[i] * sums[m]) / math.sqrt(share[i])
    products = np.triu(products) + np.triu(products, 1).T
    values, vectors = components(products / max(1, n - 1))
    ratios = values / (values.sum() or 1.0)
    k = min(k, len(numeric) + len(categorical), max(1, n - 1))
    variance = spark.createDataFrame([(f"FAMD{j + 1}", float(ratios[j]), float(ratios[:j + 1].sum())) for j in range(k)],
                                     "component string, explained_ratio double, cumulative_ratio double")
    contrib: dict = {}
    for j in range(k):
        for i, v in enumerate(owner):
            contrib[(j, v)] = contrib.get((j, v), 0.0) + float(vectors[i, j]) ** 2
    crow = [(f"FAMD{j + 1}", v, c, c * float(ratios[j]) * inertia) for (j, v), c in contrib.items()]
    contributions = spark.createDataFrame(crow, "component string, variable string, contribution double, coordinate double")
    # a row's coordinate: its z-scores, a weight for each of its levels, and a constant
    coords = []
    for j in range(k):
        total = F.lit(-float(sum(vectors[i, j] * math.sqrt(share[i]) for i in place.values())))
        total = total + _weighted(list(z.values()), vectors[:p, j])
        for c in categorical:
            weights = [x for v in design["categorical"][c] for x in
                       (F.lit(v), F.lit(float(vectors[place[c, v], j] / math.sqrt(share[place[c, v]]))))]
            total = total + F.create_map(*weights)[value[c]]
        coords.append(total.alias(f"Dim{j + 1}"))
    return variance, contributions, df.select(*keep, *coords)


def variance_thresholds(variance: DataFrame, thresholds=(0.7, 0.8, 0.9, 0.95),
                        cum_col: str = "cumulative_ratio", name_col: str = "component") -> DataFrame:
    """Components needed to reach each cumulative-variance threshold (NULL
    when not reached)."""
    spark = variance.sparkSession
    t = spark.createDataFrame([(float(x),) for x in thresholds], "threshold double")
    idx = variance.withColumn("__n", F.regexp_extract(F.col(name_col), r"(\d+)$", 1).cast("int"))
    hit = t.join(idx, F.col(cum_col) >= F.col("threshold") - 1e-12, "left")
    return hit.groupBy("threshold").agg(F.min("__n").alias("components_needed"))
