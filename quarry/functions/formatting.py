"""Numeric helpers and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(numerator: str | Column, denominator: str | Column, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale`` as double; NULL when the
    denominator is 0 (ANSI mode would raise DIVIDE_BY_ZERO)."""
    r = F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))
    return r * F.lit(scale) if scale != 1.0 else r


def format_percent(pct: str | Column) -> Column:
    """Display label: ``~x.x%`` if >= 0.1, ``x.xxxxx%`` if > 0, else ``0.0%``."""
    p = _c(pct)
    return (F.when(p >= 0.1, F.format_string("~%.1f%%", p))
            .when(p > 0, F.format_string("%.5f%%", p))
            .otherwise(F.lit("0.0%")))
