"""Calendar, time-of-day and spatial-grid derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekend day numbers of ``dayofweek`` (1 = Sunday, 7 = Saturday).
WEEKEND_DAYS = [1, 7]
SOURCE_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def derive_calendar(df: DataFrame, date_col: str, fmt: str | None = None) -> DataFrame:
    """``ts, hour, year, month, day_of_week`` (short English day name).

    ``fmt`` parses a string column; a timestamp column passes through."""
    ts = F.to_timestamp(_c(date_col), fmt) if fmt else _c(date_col)
    return df.withColumn("ts", ts).withColumns({
        "hour": F.hour("ts"),
        "year": F.year("ts"),
        "month": F.month("ts"),
        "day_of_week": F.date_format("ts", "E"),
    })


def derive_time_features(df: DataFrame, date_col: str, prefix: str = "crime") -> DataFrame:
    """Null-safe ``{prefix}_year/_month/_hour/_dayofweek`` (1 = Sunday)."""
    d = _c(date_col)
    return df.withColumns({
        f"{prefix}_year": F.year(d),
        f"{prefix}_month": F.month(d),
        f"{prefix}_hour": F.hour(d),
        f"{prefix}_dayofweek": F.dayofweek(d),
    })


def is_weekend(date_col: str | Column) -> Column:
    """TRUE on Saturday/Sunday, FALSE on weekdays, NULL for a NULL date.

    Day numbers rather than localised day names: locale-independent."""
    return F.dayofweek(_c(date_col)).isin(WEEKEND_DAYS)


def weekend_label(date_col: str | Column) -> Column:
    """'weekend' / 'weekday'; a NULL date counts as 'weekday'."""
    return F.when(is_weekend(date_col), F.lit("weekend")).otherwise(F.lit("weekday"))


def geo_grid(lat: str | Column, lon: str | Column, grid_size: float = 0.01) -> Column:
    """Cell key ``floor(lat*f)_floor(lon*f)`` with ``f = round(1/grid_size)``;
    NULL if either coordinate is NULL (``concat_ws`` alone would skip it)."""
    factor = int(round(1 / grid_size))
    la, lo = _c(lat), _c(lon)
    return F.when(
        la.isNotNull() & lo.isNotNull(),
        F.concat_ws("_", F.floor(la * factor).cast("int"), F.floor(lo * factor).cast("int")),
    )


def year_range_filter(date_col: str, year: int) -> Column:
    """``year(date) = year`` written as a range so it prunes row groups."""
    return (F.col(date_col) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (
        F.col(date_col) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))


def seconds_between(earlier: str | Column, later: str | Column) -> Column:
    """Seconds from ``earlier`` to ``later`` (double, microsecond precision),
    independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)) / F.lit(1_000_000.0)
