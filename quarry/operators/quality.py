"""Structural anomaly rules, validation and category collapse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.formatting import ratio
from quarry.operators.joins import bounded_broadcast


def _and(cs: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cs)


def anomaly_filter(df: DataFrame, rules: dict[str, tuple]) -> DataFrame:
    """Keep rows with every ruled column inside ``[lo, hi]``; NULL fails."""
    return df.filter(_and([F.col(c).between(lo, hi) for c, (lo, hi) in rules.items()]))


def anomaly_counts(df: DataFrame, rules: dict[str, tuple], coordinate_cols: tuple[str, str] | None = None,
                   date_col: str | None = None, min_year: int | None = None) -> DataFrame:
    """One pass: counts of out-of-range values per rule (NULL is not an
    anomaly), the raw sum (a row with two faults counts twice), rows with
    any fault, their % of rows and a verdict.

    ``coordinate_cols`` = (lat, lon) forms one rule: lat present and lat or
    lon outside its box (the source's coordinate rule)."""
    rule_cols: dict[str, Column] = {}
    plain = dict(rules)
    if coordinate_cols:
        lat, lon = coordinate_cols
        (la_lo, la_hi), (lo_lo, lo_hi) = plain.pop(lat), plain.pop(lon)
        rule_cols["invalid_coordinates"] = F.col(lat).isNotNull() & (
            (F.col(lat) < la_lo) | (F.col(lat) > la_hi) | (F.col(lon) < lo_lo) | (F.col(lon) > lo_hi))
    for c, (lo, hi) in plain.items():
        rule_cols[f"invalid_{c}"] = F.col(c).isNotNull() & ((F.col(c) < lo) | (F.col(c) > hi))
    if date_col and min_year:
        rule_cols["suspicious_dates"] = F.year(date_col) < min_year
    anyf = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in rule_cols.values()])
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[F.count_if(c).alias(n) for n, c in rule_cols.items()],
                 F.count_if(anyf).alias("rows_with_any_fault"))
    raw = reduce(lambda a, b: a + b, [F.col(n) for n in rule_cols])
    return (agg.withColumn("raw_sum", raw)
            .withColumn("anomaly_pct", F.round(ratio("raw_sum", "total_rows", 100.0), 4))
            .withColumn("verdict", F.when(F.col("raw_sum") == 0, "no structural anomalies")
                        .otherwise("structural anomalies detected")))


class ValidationError(ValueError):
    pass


def validate_schema(df: DataFrame, date_col: str, required: list[str]) -> None:
    """Driver-side schema checks (no job): date column present and a
    timestamp (LTZ or NTZ), required columns present."""
    if date_col not in df.columns:
        raise ValidationError(f"missing column {date_col!r}")
    if not isinstance(df.schema[date_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise ValidationError(f"{date_col!r} is not a timestamp")
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValidationError(f"missing required columns {absent}")


def violations(df: DataFrame, critical: list[str], ranges: dict[str, tuple]) -> DataFrame:
    """Long table ``(rule, violations)`` from one aggregate: NULL count of each
    critical column, out-of-range count of each ranged column, rows with any
    violation, total rows."""
    checks = {f"null_{c}": F.col(c).isNull() for c in critical}
    for c, (lo, hi) in ranges.items():
        checks[f"range_{c}"] = F.col(c).isNotNull() & ~F.col(c).between(lo, hi)
    anyv = reduce(lambda a, b: a | b, list(checks.values()))
    names = list(checks) + ["any_violation", "total_rows"]
    agg = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()],
                 F.count_if(anyv).alias("any_violation"), F.count(F.lit(1)).alias("total_rows"))
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("long").alias("violations"))
                                for n in names]))
    return agg.select(stack.alias("s")).select("s.rule", "s.violations")


def validate_frame(df: DataFrame, date_col: str, required: list[str], critical: list[str],
                   ranges: dict[str, tuple]) -> DataFrame:
    """Raise on schema faults, on an empty frame, or on any row with a NULL
    critical value / out-of-range value; otherwise return the (all-zero)
    violations table. One bounded job (``limit(1)``) decides."""
    validate_schema(df, date_col, required)
    if df.isEmpty():
        raise ValidationError("empty frame")
    bad = reduce(lambda a, b: a | b,
                 [F.col(c).isNull() for c in critical] +
                 [~F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()])
    if not df.filter(bad).limit(1).isEmpty():
        raise ValidationError("rows with NULL critical values or out-of-range values")
    return violations(df, critical, ranges)


def checked_rows(df: DataFrame, date_col: str, required: list[str], critical: list[str],
                 ranges: dict[str, tuple]) -> DataFrame:
    """``df`` unchanged, with validation inside its plan: schema faults raise
    at once, a row with a NULL critical or an out-of-range value raises when it
    is computed. No job and no copy of its own."""
    validate_schema(df, date_col, required)
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in critical] +
                 [~F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()])
    wrong = F.raise_error(F.lit("row with NULL critical value or out-of-range value")).cast("boolean")
    return df.filter(F.when(F.coalesce(bad, F.lit(True)), wrong).otherwise(F.lit(True)))


def collapse_top_categories(df: DataFrame, col: str, top_n: int, out: str | None = None,
                            other: str = "OTHER", unknown: str = "Unknown") -> DataFrame:
    """NULL -> ``unknown``; values outside the ``top_n`` most frequent (ties
    by value) -> ``other``. The top list has ``top_n`` rows: broadcast."""
    out = out or col
    filled = F.coalesce(F.col(col).cast("string"), F.lit(unknown))
    base = df.withColumn("__cat", filled)
    top = (base.groupBy("__cat").agg(F.count(F.lit(1)).alias("__n"))
           .orderBy(F.desc("__n"), F.asc("__cat")).limit(top_n)
           .select("__cat", F.lit(True).alias("__top")))
    res = base.join(bounded_broadcast(top, top_n), "__cat", "left")
    return res.withColumn(out, F.when(F.col("__top"), F.col("__cat")).otherwise(F.lit(other))) \
        .drop("__cat", "__top")
