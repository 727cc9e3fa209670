"""The 24 declared questions (filters, lookups, anti join, row windows).

Row-level windows over the fact (row number of an incident inside its
District, running count per Ward, seconds since the previous incident in
the District) go through ``sequence_within_groups``: the groups are few and
large (25 Districts), so a plain ``Window.partitionBy(district)`` would put
a whole District in one task. The range-partitioned form spreads each
group over many tasks and stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.calendar import seconds_between, year_range_filter
from quarry.functions.formatting import ratio
from quarry.operators.agg import group_count
from quarry.operators.joins import lookup_join, settled
from quarry.operators.windows import sequence_within_groups, top_per_group, topk
from quarry.plans import params as P
from quarry.plans.bindings import (DISTRICTS_SQL, INCIDENTS_SQL, SEVERITY_SQL, TIMED_SQL,
                                   district_counts, district_lookup, incidents, severity_lookup,
                                   timed_incidents, with_sql)

INC = with_sql(INCIDENTS_SQL)
KEYS = ["order_key", "line_number", "part_key", "beat"]
ORDER_KEYS = ["order_key", "line_number", "part_key", "beat", "latitude", "longitude"]
_K = ", ".join(KEYS)
_OK = ", ".join(ORDER_KEYS)


def _rows(spark, sf, cols: list[str], cond: Column) -> DataFrame:
    return incidents(spark, sf, KEYS + [c for c in cols if c not in KEYS]).filter(cond)


# --- filters -------------------------------------------------------------

def bq1_filter_two_eq(spark, sf):
    return _rows(spark, sf, ["primary_type", "description"],
                 (F.col("primary_type") == P.BQ_TYPE) & (F.col("description") == P.BQ_DESCRIPTION))


def bq2_filter_two_bool(spark, sf):
    return _rows(spark, sf, ["domestic", "arrest"], F.col("domestic") & ~F.col("arrest"))


def bq3_filter_location(spark, sf):
    return _rows(spark, sf, ["location_description"], F.col("location_description") == P.BQ_LOCATION)


def bq4_filter_year(spark, sf):
    return _rows(spark, sf, ["incident_date"], year_range_filter("incident_date", P.BQ_YEAR))


def bq5_filter_street_night(spark, sf):
    # needs a time of day, which the dates of the star lack: bound to ``events``
    h = F.hour("incident_ts")
    start, end = P.LATE_NIGHT_HOURS
    return timed_incidents(spark, sf).filter((F.col("primary_type") == P.STREET_EVENT) & ((h >= start) | (h < end)))


def bq6_filter_type(spark, sf):
    return _rows(spark, sf, ["primary_type"], F.col("primary_type") == P.BQ_NARCOTICS_TYPE)


def bq7_valid_coordinates(spark, sf):
    return _rows(spark, sf, ["latitude", "longitude"],
                 F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def bq8_filter_ward(spark, sf):
    return _rows(spark, sf, ["ward"], F.col("ward") == P.BQ_WARD)


# --- grouped counts --------------------------------------------------------

def bq9_count_by_type(spark, sf):
    return group_count(incidents(spark, sf, ["primary_type"]), ["primary_type"])


def bq10_rate_by_district(spark, sf):
    g = district_counts(spark, sf, {"arrests": F.col("arrest"), "total": F.lit(True)})
    return g.select("district", ratio("arrests", "total", 100.0).alias("arrest_rate"))


def bq11_by_month(spark, sf):
    df = incidents(spark, sf, ["incident_date"]).select(F.month("incident_date").alias("month"))
    return group_count(df, ["month"])


def bq12_top5_locations(spark, sf):
    g = group_count(incidents(spark, sf, ["location_description"]), ["location_description"])
    return topk(g, [F.desc("count"), F.asc("location_description")], 5)


def bq13_domestic_by_year(spark, sf):
    df = incidents(spark, sf, ["incident_date", "domestic"]).filter(F.col("domestic"))
    return group_count(df.select(F.year("incident_date").alias("year")), ["year"])


def bq14_code_distribution(spark, sf):
    return group_count(incidents(spark, sf, ["fbi_code"]), ["fbi_code"])


def bq15_by_hour(spark, sf):
    df = timed_incidents(spark, sf).select(F.hour("incident_ts").alias("hour"))
    return group_count(df, ["hour"])


def bq16_pair_counts(spark, sf):
    return group_count(incidents(spark, sf, ["district", "ward"]), ["district", "ward"])


# --- lookups ---------------------------------------------------------------

def bq17_severity_join(spark, sf):
    sev = settled(severity_lookup(spark, sf, P.SEVERITY_LEAVE_OUT), "severity")
    return lookup_join(incidents(spark, sf, KEYS + ["primary_type"]), sev, ["primary_type"], ["severity_rank", "severity"])


def bq18_named_districts(spark, sf):
    names = district_lookup(spark, sf).drop("is_central")
    return incidents(spark, sf, KEYS + ["district"]).join(names, "district", "inner")


def bq19_two_lookup_join(spark, sf):
    # written, so that the planner knows its size
    sev = settled(severity_lookup(spark, sf, P.SEVERITY_LEAVE_OUT).filter(F.col("severity") == "critical"), "critical")
    names = district_lookup(spark, sf).filter(F.col("is_central"))
    df = incidents(spark, sf, KEYS + ["primary_type", "district"])
    return (df.join(sev, "primary_type").join(names, "district")
            .select(*KEYS, "primary_type", "severity", "district", "district_name"))


def bq20_anti_join(spark, sf):
    types = incidents(spark, sf, ["primary_type"]).distinct()   # aggregate first
    sev = severity_lookup(spark, sf, P.SEVERITY_LEAVE_OUT).select("primary_type")
    return types.join(sev, "primary_type", "left_anti")


# --- row windows over the fact -------------------------------------------

# The source data has rows without District or Ward; the tables have none, so
# some are injected here by a key rule, the same in the oracle.
NO_GROUP = "order_key % 13 = 0"


def _grouped(spark, sf, group: str) -> DataFrame:
    df = incidents(spark, sf, [*ORDER_KEYS, group, "incident_date", "description"])
    return df.withColumn(group, F.when(~F.expr(NO_GROUP), F.col(group)))


def bq21_row_number_by_date(spark, sf):
    df = _grouped(spark, sf, "district")
    out = sequence_within_groups(df, ["district"], ["incident_date", *ORDER_KEYS], out="row_num")
    return out.select("district", "incident_date", *KEYS, "row_num")


def bq22_running_total(spark, sf):
    # running count over a ROWS frame == position in the ordered group
    df = _grouped(spark, sf, "ward")
    out = sequence_within_groups(df, ["ward"], ["incident_date", *ORDER_KEYS], out="running_total")
    return out.select("ward", "incident_date", *KEYS, "running_total")


def interval_seconds(df: DataFrame, group: str, date: str, order_keys: list[str]) -> DataFrame:
    """``diff_seconds`` = seconds since the previous incident of the group
    (``lag`` in (date, key) order); NULL for the first one."""
    out = sequence_within_groups(df, [group], [date, *order_keys], out="__rn", lag_cols=[date])
    return out.withColumn("diff_seconds", seconds_between(f"lag_{date}", date)).drop("__rn", f"lag_{date}")


def bq23_lag_diff(spark, sf):
    df = _grouped(spark, sf, "district")
    return interval_seconds(df, "district", "incident_date", ORDER_KEYS).select(
        "district", "incident_date", *KEYS, "diff_seconds")


def bq24_top_type_per_district(spark, sf):
    g = group_count(incidents(spark, sf, ["district", "primary_type"]), ["district", "primary_type"])
    return top_per_group(g, ["district"], [F.desc("count"), F.asc("primary_type")], 1,
                         kind="row_number", out=None)


QUERIES = {name: fn for name, fn in list(globals().items())
           if name.startswith("bq") and name[2].isdigit() and callable(fn)}


# --- oracle ---------------------------------------------------------------

GAPS_SQL = f"""gaps AS (SELECT * REPLACE (CASE WHEN NOT ({NO_GROUP}) THEN district END AS district,
    CASE WHEN NOT ({NO_GROUP}) THEN ward END AS ward) FROM incidents)"""
INC_GAPS = with_sql(INCIDENTS_SQL, GAPS_SQL)
_LATE = f"(hour(incident_ts) >= {P.LATE_NIGHT_HOURS[0]} OR hour(incident_ts) < {P.LATE_NIGHT_HOURS[1]})"

ORACLE = {
    "bq1_filter_two_eq": INC + f"SELECT {_K}, primary_type, description FROM incidents "
                               f"WHERE primary_type = '{P.BQ_TYPE}' AND description = '{P.BQ_DESCRIPTION}'",
    "bq2_filter_two_bool": INC + f"SELECT {_K}, domestic, arrest FROM incidents WHERE domestic AND NOT arrest",
    "bq3_filter_location": INC + f"SELECT {_K}, location_description FROM incidents "
                                 f"WHERE location_description = '{P.BQ_LOCATION}'",
    "bq4_filter_year": INC + f"SELECT {_K}, incident_date FROM incidents WHERE year(incident_date) = {P.BQ_YEAR}",
    "bq5_filter_street_night": with_sql(TIMED_SQL) + "SELECT incident_id, incident_ts, primary_type FROM timed "
                                                     f"WHERE primary_type = '{P.STREET_EVENT}' AND {_LATE}",
    "bq6_filter_type": INC + f"SELECT {_K}, primary_type FROM incidents WHERE primary_type = '{P.BQ_NARCOTICS_TYPE}'",
    "bq7_valid_coordinates": INC + f"SELECT {_K}, latitude, longitude FROM incidents "
                                   "WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "bq8_filter_ward": INC + f"SELECT {_K}, ward FROM incidents WHERE ward = {P.BQ_WARD}",
    "bq9_count_by_type": INC + "SELECT primary_type, count(*) AS count FROM incidents GROUP BY 1",
    "bq10_rate_by_district": INC + "SELECT district, count_if(arrest) / count(*) * 100 AS arrest_rate "
                                   "FROM incidents GROUP BY 1",
    "bq11_by_month": INC + "SELECT CAST(month(incident_date) AS INTEGER) AS month, count(*) AS count "
                           "FROM incidents GROUP BY 1",
    "bq12_top5_locations": INC + "SELECT location_description, count(*) AS count FROM incidents GROUP BY 1 "
                                 "ORDER BY count DESC, location_description LIMIT 5",
    "bq13_domestic_by_year": INC + "SELECT CAST(year(incident_date) AS INTEGER) AS year, count(*) AS count "
                                   "FROM incidents WHERE domestic GROUP BY 1",
    "bq14_code_distribution": INC + "SELECT fbi_code, count(*) AS count FROM incidents GROUP BY 1",
    "bq15_by_hour": with_sql(TIMED_SQL) + "SELECT CAST(hour(incident_ts) AS INTEGER) AS hour, count(*) AS count "
                                          "FROM timed GROUP BY 1",
    "bq16_pair_counts": INC + "SELECT district, ward, count(*) AS count FROM incidents GROUP BY 1, 2",
    "bq17_severity_join": with_sql(INCIDENTS_SQL, SEVERITY_SQL) +
        f"SELECT {', '.join('i.' + k for k in KEYS)}, i.primary_type, s.severity_rank, s.severity "
        "FROM incidents i LEFT JOIN severity s ON i.primary_type = s.primary_type",
    "bq18_named_districts": with_sql(INCIDENTS_SQL, DISTRICTS_SQL) +
        f"SELECT {', '.join('i.' + k for k in KEYS)}, i.district, d.district_name "
        "FROM incidents i JOIN districts d ON i.district = d.district",
    "bq19_two_lookup_join": with_sql(INCIDENTS_SQL, SEVERITY_SQL, DISTRICTS_SQL) +
        f"SELECT {', '.join('i.' + k for k in KEYS)}, i.primary_type, s.severity, i.district, d.district_name "
        "FROM incidents i JOIN severity s ON i.primary_type = s.primary_type "
        "JOIN districts d ON i.district = d.district WHERE s.severity = 'critical' AND d.is_central",
    "bq20_anti_join": with_sql(INCIDENTS_SQL, SEVERITY_SQL) +
        "SELECT DISTINCT primary_type FROM incidents WHERE primary_type NOT IN (SELECT primary_type FROM severity)",
    "bq21_row_number_by_date": INC_GAPS + f"SELECT district, incident_date, {_K}, "
        f"row_number() OVER (PARTITION BY district ORDER BY incident_date, {_OK}) AS row_num FROM gaps",
    "bq22_running_total": INC_GAPS + f"SELECT ward, incident_date, {_K}, "
        f"count(*) OVER (PARTITION BY ward ORDER BY incident_date, {_OK} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total FROM gaps",
    "bq23_lag_diff": INC_GAPS + f"SELECT district, incident_date, {_K}, "
        "(epoch_us(incident_date) - epoch_us(lag(incident_date) OVER "
        f"(PARTITION BY district ORDER BY incident_date, {_OK}))) / 1000000.0 AS diff_seconds FROM gaps",
    "bq24_top_type_per_district": INC + "SELECT district, primary_type, count FROM ("
        "SELECT district, primary_type, count(*) AS count, row_number() OVER "
        "(PARTITION BY district ORDER BY count(*) DESC, primary_type) AS rn "
        "FROM incidents GROUP BY 1, 2) WHERE rn = 1",
}
