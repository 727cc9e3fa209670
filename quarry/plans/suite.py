"""The 24 business questions over the incident roles.

Each question is a function of a DataFrame with role columns; ``QUERIES``
binds it to the supplied tables and ``ORACLE`` states the same question as
DuckDB SQL over the full five-way join.

Plan shape (see ``.explain``): every question scans the fact once after exchange reuse. The
"count A, count B, inner join" questions are one ``count_if`` aggregate;
global ranks are computed inside a distributed top-k prefix; per-group
top-1 uses ``WindowGroupLimit`` on the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.address import sql_street_name, street_name
from quarry.functions.calendar import is_weekend, weekend_label, year_range_filter
from quarry.functions.formatting import ratio
from quarry.operators.agg import conditional_counts, global_aggregate, group_count
from quarry.operators.joins import attach_scalar, bounded_broadcast, semi_join_top
from quarry.operators.windows import (cumulative_sum, moving_average, rank_prefix,
                                      top_per_group, topk)
from quarry.plans import params as P
from quarry.plans.bindings import (INCIDENTS_SQL, TIMED_SQL, district_counts, incidents,
                                   timed_incidents, with_sql)

INC = with_sql(INCIDENTS_SQL)
TIMED = with_sql(TIMED_SQL)


# --------------------------------------------------------------------------
# question operators (column-parametric)

def hour_band_counts(df: DataFrame, ts: str, key: str, band: tuple[int, int]) -> DataFrame:
    """Incidents with hour in [start, end), counted by ``key``."""
    h = F.hour(ts)
    return group_count(df.filter((h >= band[0]) & (h < band[1])), [key])


def weekend_share(df: DataFrame, date: str) -> DataFrame:
    return group_count(df.select(weekend_label(date).alias("is_weekend")), ["is_weekend"])


def ratio_of_two_types(df: DataFrame, key: str, type_col: str, a: str, b: str, k: int) -> DataFrame:
    t = F.col(type_col)
    counts = conditional_counts(df, [key], {"count_a": t == a, "count_b": t == b})
    counts = counts.withColumn("ratio", ratio("count_a", "count_b"))
    return topk(counts, [F.desc("count_a"), F.asc(key)], k)


def filtered_group_count(df: DataFrame, cond, key: str) -> DataFrame:
    return group_count(df.filter(cond), [key])


def rate_rank(df: DataFrame, key: str, flag: str, k: int, total_name: str, hits_name: str,
              rate_name: str, min_total: int | None = None) -> DataFrame:
    """Total and flagged counts by key (both > 0), rate in %, global
    ``dense_rank`` by rate (computed before the ``min_total`` filter), first
    ``k`` rows by (rank, key)."""
    counts = conditional_counts(df.filter(F.col(key).isNotNull()), [key],
                                {total_name: F.lit(True), hits_name: F.col(flag)})
    counts = counts.withColumn(rate_name, ratio(hits_name, total_name, 100.0))
    if min_total is None:
        return rank_prefix(counts, rate_name, k, "dense_rank", [key], limit_rows=k)
    # rank over ALL keys, filter afterwards: the k output rows are the k best
    # rates among keys passing the filter; their dense rank counts the
    # distinct rates (of all keys) at or above their rate.
    passing = counts.filter(F.col(total_name) > min_total)
    out = topk(passing, [F.desc(rate_name), F.asc(key)], k)
    # for each of the k rates, count the distinct rates above it: k conditional
    # counts in one aggregate, no ordering of all rates
    marks = out.agg(F.sort_array(F.collect_set(rate_name)).alias("__marks"))   # at most k values
    rates = attach_scalar(counts.select(rate_name).distinct(), marks)
    above = (rates.select(F.explode(F.filter("__marks", lambda m: m < F.col(rate_name))).alias("__mark"))
             .groupBy("__mark").agg(F.count(F.lit(1)).alias("__above")))
    ranked = out.join(bounded_broadcast(above, k), F.col(rate_name) == F.col("__mark"), "left")
    return ranked.select(*out.columns, (F.coalesce("__above", F.lit(0)) + 1).cast("int").alias("rank"))


def monthly_moving_average(df: DataFrame, date: str, rows: int = 3) -> DataFrame:
    ym = F.date_format(date, "yyyy-MM")
    monthly = group_count(df.select(ym.alias("year_month")).filter(F.col("year_month").isNotNull()),
                          ["year_month"])
    return moving_average(monthly, "year_month", "count", rows, out="moving_avg_3m") \
        .withColumn("moving_avg_3m", F.round("moving_avg_3m", 6))


def top_keys(df: DataFrame, key: str, k: int, cond=None, drop_null: bool = False) -> DataFrame:
    if cond is not None:
        df = df.filter(cond)
    if drop_null:
        df = df.filter(F.col(key).isNotNull())
    return topk(group_count(df, [key]), [F.desc("count"), F.asc(key)], k)


def locations_of_top_types(df: DataFrame, type_col: str, loc_col: str, n_types: int, k: int) -> DataFrame:
    return top_keys(semi_join_top(df, type_col, n_types), loc_col, k, drop_null=True)


def top_type_per_group(df: DataFrame, key: str, type_col: str) -> DataFrame:
    grouped = group_count(df.filter(F.col(key).isNotNull()), [key, type_col])
    return top_per_group(grouped, [key], [F.desc("count")], 1, kind="rank").withColumn(
        "rank", F.col("rank").cast("int"))


def top_block_share(df: DataFrame, key: str, block: str, min_total: int, k: int) -> DataFrame:
    """Top block per district and its share of the district, for districts
    with more than ``min_total`` incidents. One scan: district totals are
    sums of the (district, block) counts."""
    blocks = group_count(df.filter(F.col(key).isNotNull()), [key, block])
    totals = (blocks.groupBy(key).agg(F.sum("count").alias("dist_total"))
              .filter(F.col("dist_total") > min_total))
    named = blocks.filter(F.col(block).isNotNull())
    top = top_per_group(named, [key], [F.desc("count"), F.asc(block)], 1, kind="row_number")
    top = top.withColumn("rank", F.col("rank").cast("int"))
    joined = top.join(totals, key).withColumn("share_percent", ratio("count", "dist_total", 100.0))
    return topk(joined, [F.desc("share_percent"), F.asc(key)], k)


def flag_share_in_year(df: DataFrame, date: str, type_col: str, flag: str, year: int) -> DataFrame:
    """Per type within one year: flagged count, total, share. Types with no
    flagged rows are absent (same rows as count-by-(type, flag) + window +
    ``flag = true``, in one aggregate)."""
    g = (df.filter(year_range_filter(date, year)).groupBy(type_col)
         .agg(F.count_if(F.col(flag)).alias("count"), F.count(F.lit(1)).alias("total_count")))
    return (g.filter(F.col("count") > 0)
            .select(type_col, F.lit(True).alias(flag), "count", "total_count",
                    ratio("count", "total_count").alias("share")))


def weekday_weekend_by(df: DataFrame, key: str, date: str, k: int) -> DataFrame:
    wk = is_weekend(date)
    counts = conditional_counts(df, [key], {"weekend_count": wk, "weekday_count": ~wk})
    return topk(counts, [F.desc("weekend_count"), F.asc(key)], k)


def flag_split_rank(counts: DataFrame, key: str, k: int) -> DataFrame:
    counts = counts.withColumn("total", F.col("domestic") + F.col("non_domestic"))
    return rank_prefix(counts, "total", k, "rank", [key])


def street_counts(df: DataFrame, block: str, predicates: dict) -> DataFrame:
    """Conditional counts per street: counted per distinct block first, so the
    address is parsed once per block instead of once per incident."""
    blocks = conditional_counts(df, [block], predicates, require_all=False)
    streets = blocks.groupBy(street_name(block).alias("street_name"))
    return streets.agg(*[F.sum(n).cast("long").alias(n) for n in predicates])


def type_rank_in_area(df: DataFrame, area_col: str, area: int, type_col: str, k: int) -> DataFrame:
    counts = group_count(df.filter(F.col(area_col) == area), [type_col])
    return rank_prefix(counts, "count", k, "dense_rank", [type_col])


def cumulative_by_year(df: DataFrame, date: str, flag: str) -> DataFrame:
    yearly = group_count(df.filter(F.col(flag)).select(F.date_format(date, "yyyy").alias("year")),
                         ["year"])
    return cumulative_sum(yearly, "year", "count", out="cumulative_arrests")


def above_average(df: DataFrame, key: str, k: int) -> DataFrame:
    counts = group_count(df.filter(F.col(key).isNotNull()), [key])
    avg = global_aggregate(counts, {"avg_count": F.avg("count")})
    both = attach_scalar(counts, avg).filter(F.col("count") > F.col("avg_count"))
    return topk(both, [F.desc("count"), F.asc(key)], k)


# --------------------------------------------------------------------------
# bindings to the supplied tables

def _inc(spark: SparkSession, sf: str, *roles: str) -> DataFrame:
    return incidents(spark, sf, list(roles))


def q1_d_night(spark, sf):
    return hour_band_counts(timed_incidents(spark, sf), "incident_ts", "primary_type", P.NIGHT_HOURS)


def q2_d_weekend_share(spark, sf):
    return weekend_share(_inc(spark, sf, "incident_date"), "incident_date")


def q3_d_ratio_by_district(spark, sf):
    return ratio_of_two_types(_inc(spark, sf, "district", "primary_type"), "district",
                              "primary_type", P.TYPE_A, P.TYPE_B, 15)


def q4_d_domestic_by_district(spark, sf):
    # eager aggregation below the supplier join; districts without a
    # domestic incident are absent, as in filter + group count
    return district_counts(spark, sf, {"count": F.col("domestic")}).filter(F.col("count") > 0)


def q5_d_arrest_ratio_by_ward(spark, sf):
    return rate_rank(_inc(spark, sf, "ward", "arrest"), "ward", "arrest", 15,
                     "total_crimes", "arrests", "arrest_rate")


def q6_d_moving_average(spark, sf):
    return monthly_moving_average(_inc(spark, sf, "incident_date"), "incident_date")


def q1_j_top_theft_districts(spark, sf):
    return top_keys(_inc(spark, sf, "district", "primary_type"), "district", 10,
                    cond=F.col("primary_type") == P.THEFT_TYPE)


def q2_j_domestic_monthly(spark, sf):
    df = _inc(spark, sf, "incident_date", "domestic").filter(F.col("domestic"))
    return group_count(df.select(F.month("incident_date").alias("month_num")), ["month_num"])


def q3_j_top5_type_locations(spark, sf):
    return locations_of_top_types(_inc(spark, sf, "primary_type", "location_description"),
                                  "primary_type", "location_description", 5, 10)


def q4_j_top_streets(spark, sf):
    counts = street_counts(_inc(spark, sf, "block"), "block", {"count": F.lit(True)})
    return topk(counts, [F.desc("count"), F.asc("street_name")], 10)


def q5_j_top_type_per_district(spark, sf):
    return top_type_per_group(_inc(spark, sf, "district", "primary_type"), "district", "primary_type")


def q6_j_block_share(spark, sf):
    return top_block_share(_inc(spark, sf, "district", "block"), "district", "block",
                           P.DISTRICT_MIN_TOTAL, 10)


def q1_m_arrest_by_type(spark, sf):
    return filtered_group_count(_inc(spark, sf, "primary_type", "arrest"), F.col("arrest"), "primary_type")


def q2_m_arrest_share_year(spark, sf):
    return flag_share_in_year(_inc(spark, sf, "incident_date", "primary_type", "arrest"),
                              "incident_date", "primary_type", "arrest", P.SHARE_YEAR)


def q3_m_weekday_weekend_district(spark, sf):
    return weekday_weekend_by(_inc(spark, sf, "district", "incident_date"), "district", "incident_date", 10)


def q4_m_domestic_vs_non_streets(spark, sf):
    counts = street_counts(_inc(spark, sf, "block", "domestic"), "block",
                           {"domestic": F.col("domestic"), "non_domestic": ~F.col("domestic")})
    return flag_split_rank(counts.filter("domestic > 0 and non_domestic > 0"), "street_name", 10)


def q5_m_type_rank_in_area(spark, sf):
    return type_rank_in_area(_inc(spark, sf, "community_area", "primary_type"),
                             "community_area", P.AREA, "primary_type", 10)


def q6_m_hourly(spark, sf):
    df = timed_incidents(spark, sf).select(F.hour("incident_ts").alias("hour"))
    return group_count(df, ["hour"])


def q1_v_damage_locations(spark, sf):
    return top_keys(_inc(spark, sf, "primary_type", "location_description"), "location_description",
                    10, cond=F.col("primary_type") == P.DAMAGE_TYPE)


def q2_v_street_types(spark, sf):
    return filtered_group_count(_inc(spark, sf, "primary_type", "location_description"),
                                F.col("location_description") == P.STREET_LOCATION, "primary_type")


def q3_v_day(spark, sf):
    return hour_band_counts(timed_incidents(spark, sf), "incident_ts", "primary_type", P.DAY_HOURS)


def q4_v_cumulative_by_year(spark, sf):
    return cumulative_by_year(_inc(spark, sf, "incident_date", "arrest"), "incident_date", "arrest")


def q5_v_beats_above_avg(spark, sf):
    return above_average(_inc(spark, sf, "beat"), "beat", 15)


def q6_v_code_success(spark, sf):
    # code role bound to the supplier key so the > CODE_MIN_TOTAL filter bites
    df = _inc(spark, sf, "beat", "arrest").withColumnRenamed("beat", "code")
    return rate_rank(df, "code", "arrest", 12, "total", "arrests", "success_rate",
                     min_total=P.CODE_MIN_TOTAL)


QUERIES = {name: fn for name, fn in list(globals().items())
           if name[:2] in ("q1", "q2", "q3", "q4", "q5", "q6") and callable(fn)}


# --------------------------------------------------------------------------
# oracle SQL (DuckDB)

_STREET = sql_street_name("block")

ORACLE = {
    "q1_d_night": TIMED + f"""
SELECT primary_type, count(*) AS count FROM timed
WHERE hour(incident_ts) >= {P.NIGHT_HOURS[0]} AND hour(incident_ts) < {P.NIGHT_HOURS[1]}
GROUP BY primary_type""",
    "q2_d_weekend_share": INC + """
SELECT CASE WHEN dayofweek(incident_date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS is_weekend,
       count(*) AS count
FROM incidents GROUP BY 1""",
    "q3_d_ratio_by_district": INC + f"""
SELECT a.district, a.count_a, b.count_b, a.count_a / b.count_b AS ratio
FROM (SELECT district, count(*) AS count_a FROM incidents WHERE primary_type = '{P.TYPE_A}' GROUP BY district) a
JOIN (SELECT district, count(*) AS count_b FROM incidents WHERE primary_type = '{P.TYPE_B}' GROUP BY district) b
  ON a.district = b.district
ORDER BY a.count_a DESC, a.district LIMIT 15""",
    "q4_d_domestic_by_district": INC + """
SELECT district, count(*) AS count FROM incidents WHERE domestic GROUP BY district""",
    "q5_d_arrest_ratio_by_ward": INC + """
SELECT * FROM (
  SELECT t.ward, t.total_crimes, a.arrests, a.arrests / t.total_crimes * 100 AS arrest_rate,
         CAST(dense_rank() OVER (ORDER BY a.arrests / t.total_crimes * 100 DESC) AS INTEGER) AS rank
  FROM (SELECT ward, count(*) AS total_crimes FROM incidents WHERE ward IS NOT NULL GROUP BY ward) t
  JOIN (SELECT ward, count(*) AS arrests FROM incidents WHERE ward IS NOT NULL AND arrest GROUP BY ward) a
    ON t.ward = a.ward)
ORDER BY rank, ward LIMIT 15""",
    "q6_d_moving_average": INC + """
SELECT year_month, count,
       round(avg(count) OVER (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_avg_3m
FROM (SELECT strftime(incident_date, '%Y-%m') AS year_month, count(*) AS count
      FROM incidents WHERE incident_date IS NOT NULL GROUP BY 1)""",
    "q1_j_top_theft_districts": INC + f"""
SELECT district, count(*) AS count FROM incidents WHERE primary_type = '{P.THEFT_TYPE}'
GROUP BY district ORDER BY count DESC, district LIMIT 10""",
    "q2_j_domestic_monthly": INC + """
SELECT CAST(month(incident_date) AS INTEGER) AS month_num, count(*) AS count
FROM incidents WHERE domestic GROUP BY 1""",
    "q3_j_top5_type_locations": INC + """
SELECT location_description, count(*) AS count FROM incidents
WHERE primary_type IN (SELECT primary_type FROM incidents GROUP BY primary_type
                       ORDER BY count(*) DESC, primary_type LIMIT 5)
  AND location_description IS NOT NULL
GROUP BY location_description ORDER BY count DESC, location_description LIMIT 10""",
    "q4_j_top_streets": INC + f"""
SELECT street_name, count(*) AS count FROM (SELECT {_STREET} AS street_name FROM incidents)
GROUP BY street_name ORDER BY count DESC, street_name LIMIT 10""",
    "q5_j_top_type_per_district": INC + """
SELECT district, primary_type, count, rank FROM (
  SELECT district, primary_type, count(*) AS count,
         CAST(rank() OVER (PARTITION BY district ORDER BY count(*) DESC) AS INTEGER) AS rank
  FROM incidents WHERE district IS NOT NULL GROUP BY district, primary_type)
WHERE rank = 1""",
    "q6_j_block_share": INC + f"""
SELECT b.district, b.block, b.count, b.rank, t.dist_total, b.count / t.dist_total * 100 AS share_percent
FROM (SELECT district, block, count, CAST(row_number() OVER (PARTITION BY district ORDER BY count DESC, block) AS INTEGER) AS rank
      FROM (SELECT district, block, count(*) AS count FROM incidents WHERE block IS NOT NULL AND district IS NOT NULL
            GROUP BY district, block)) b
JOIN (SELECT district, count(*) AS dist_total FROM incidents WHERE district IS NOT NULL GROUP BY district
      HAVING count(*) > {P.DISTRICT_MIN_TOTAL}) t ON b.district = t.district
WHERE b.rank = 1
ORDER BY share_percent DESC, b.district LIMIT 10""",
    "q1_m_arrest_by_type": INC + """
SELECT primary_type, count(*) AS count FROM incidents WHERE arrest GROUP BY primary_type""",
    "q2_m_arrest_share_year": INC + f"""
SELECT primary_type, arrest, count, total_count, count / total_count AS share FROM (
  SELECT primary_type, arrest, count(*) AS count,
         CAST(sum(count(*)) OVER (PARTITION BY primary_type) AS BIGINT) AS total_count
  FROM incidents WHERE year(incident_date) = {P.SHARE_YEAR} GROUP BY primary_type, arrest)
WHERE arrest""",
    "q3_m_weekday_weekend_district": INC + """
SELECT e.district, e.weekend_count, d.weekday_count
FROM (SELECT district, count(*) AS weekend_count FROM incidents WHERE dayofweek(incident_date) IN (0, 6) GROUP BY district) e
JOIN (SELECT district, count(*) AS weekday_count FROM incidents WHERE dayofweek(incident_date) NOT IN (0, 6) GROUP BY district) d
  ON e.district = d.district
ORDER BY e.weekend_count DESC, e.district LIMIT 10""",
    "q4_m_domestic_vs_non_streets": with_sql(INCIDENTS_SQL, f"s AS (SELECT {_STREET} AS street_name, domestic FROM incidents)") + """
SELECT * FROM (
  SELECT a.street_name, a.domestic, b.non_domestic, a.domestic + b.non_domestic AS total,
         CAST(rank() OVER (ORDER BY a.domestic + b.non_domestic DESC) AS INTEGER) AS rank
  FROM (SELECT street_name, count(*) AS domestic FROM s WHERE domestic GROUP BY street_name) a
  JOIN (SELECT street_name, count(*) AS non_domestic FROM s WHERE NOT domestic GROUP BY street_name) b
    ON a.street_name = b.street_name)
WHERE rank <= 10""",
    "q5_m_type_rank_in_area": INC + f"""
SELECT * FROM (
  SELECT primary_type, count(*) AS count,
         CAST(dense_rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank
  FROM incidents WHERE community_area = {P.AREA} GROUP BY primary_type)
WHERE rank <= 10""",
    "q6_m_hourly": TIMED + """
SELECT CAST(hour(incident_ts) AS INTEGER) AS hour, count(*) AS count FROM timed GROUP BY 1""",
    "q1_v_damage_locations": INC + f"""
SELECT location_description, count(*) AS count FROM incidents WHERE primary_type = '{P.DAMAGE_TYPE}'
GROUP BY location_description ORDER BY count DESC, location_description LIMIT 10""",
    "q2_v_street_types": INC + f"""
SELECT primary_type, count(*) AS count FROM incidents WHERE location_description = '{P.STREET_LOCATION}'
GROUP BY primary_type""",
    "q3_v_day": TIMED + f"""
SELECT primary_type, count(*) AS count FROM timed
WHERE hour(incident_ts) >= {P.DAY_HOURS[0]} AND hour(incident_ts) < {P.DAY_HOURS[1]}
GROUP BY primary_type""",
    "q4_v_cumulative_by_year": INC + """
SELECT year, count, CAST(sum(count) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_arrests
FROM (SELECT strftime(incident_date, '%Y') AS year, count(*) AS count FROM incidents WHERE arrest GROUP BY 1)""",
    "q5_v_beats_above_avg": with_sql(INCIDENTS_SQL, "b AS (SELECT beat, count(*) AS count FROM incidents WHERE beat IS NOT NULL GROUP BY beat)") + """
SELECT beat, count, avg_count FROM b, (SELECT avg(count) AS avg_count FROM b)
WHERE count > avg_count ORDER BY count DESC, beat LIMIT 15""",
    "q6_v_code_success": INC + f"""
SELECT code, total, arrests, success_rate, rank FROM (
  SELECT t.code, t.total, a.arrests, a.arrests / t.total * 100 AS success_rate,
         CAST(dense_rank() OVER (ORDER BY a.arrests / t.total * 100 DESC) AS INTEGER) AS rank
  FROM (SELECT beat AS code, count(*) AS total FROM incidents WHERE beat IS NOT NULL GROUP BY beat) t
  JOIN (SELECT beat AS code, count(*) AS arrests FROM incidents WHERE beat IS NOT NULL AND arrest GROUP BY beat) a
    ON t.code = a.code)
WHERE total > {P.CODE_MIN_TOTAL}
ORDER BY rank, code LIMIT 12""",
}
