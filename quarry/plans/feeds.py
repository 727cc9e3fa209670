"""Chart feeds: the aggregations behind each chart (drawing is not built)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.formatting import ratio
from quarry.operators.agg import group_count, quantiles
from quarry.operators.joins import attach_scalar
from quarry.operators.windows import topk
from quarry.plans.bindings import (INCIDENTS_SQL, TIMED_SQL, district_counts, incidents, timed_incidents,
                                   with_sql)
from quarry.plans.declared import INC_GAPS, ORDER_KEYS, _grouped, interval_seconds

INC = with_sql(INCIDENTS_SQL)
BINS = 40


def feed_yearly(spark, sf):
    return group_count(incidents(spark, sf, ["incident_date"]).select(F.year("incident_date").alias("year")), ["year"])


def feed_monthly(spark, sf):
    return group_count(incidents(spark, sf, ["incident_date"]).select(F.month("incident_date").alias("month")), ["month"])


def feed_hourly(spark, sf):
    return group_count(timed_incidents(spark, sf).select(F.hour("incident_ts").alias("hour")), ["hour"])


def _top(df, col, k, feed):
    g = topk(group_count(df, [col]), [F.desc("count"), F.asc(col)], k)
    return g.select(F.lit(feed).alias("feed"), F.col(col).cast("string").alias("value"), "count")


def feed_top_categories(spark, sf):
    df = incidents(spark, sf, ["district", "location_description", "primary_type"])
    return (_top(df, "district", 15, "district").unionByName(_top(df, "location_description", 10, "location"))
            .unionByName(_top(df, "primary_type", 10, "type")))


def feed_boolean_share(spark, sf):
    df = incidents(spark, sf, ["arrest", "domestic"])
    # one aggregate for both flags
    g = df.agg(F.count_if(F.col("arrest")).alias("a1"), F.count_if(~F.col("arrest")).alias("a0"),
               F.count_if(F.col("domestic")).alias("d1"), F.count_if(~F.col("domestic")).alias("d0"))
    cells = [("arrest", "true", "a1"), ("arrest", "false", "a0"), ("domestic", "true", "d1"),
             ("domestic", "false", "d0")]
    return g.select(F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.lit(v).alias("value"),
                                                 F.col(c).alias("count")) for f, v, c in cells])).alias("s")).select("s.*")


def feed_rate_vs_volume(spark, sf):
    g = district_counts(spark, sf, {"arrests": F.col("arrest"), "count": F.lit(True)})
    return g.select("district", ratio("arrests", "count", 100.0).alias("arrest_rate"), "count")


def _intervals(spark, sf):
    df = _grouped(spark, sf, "district")
    return interval_seconds(df, "district", "incident_date", ORDER_KEYS).filter(F.col("diff_seconds").isNotNull())


def feed_interval_hist(spark, sf):
    """40 equal-width bins over [min, max]; the max falls in the last bin."""
    x = _intervals(spark, sf).select("diff_seconds")
    st = x.agg(F.min("diff_seconds").alias("lo"), F.max("diff_seconds").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / BINS
    binned = attach_scalar(x, st).select(
        F.when(F.col("hi") == F.col("lo"), F.lit(0))
         .otherwise(F.least(F.floor((F.col("diff_seconds") - F.col("lo")) / width), F.lit(BINS - 1)))
         .cast("int").alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    grid = st.select(F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"), "lo", "hi")
    return (grid.join(counts, "bin", "left")
            .select("bin", F.round(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / BINS, 6).alias("bin_start"),
                    F.round(F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / BINS, 6).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def feed_interval_box(spark, sf):
    """Five numbers of the intervals, all positions of one radix selection."""
    return quantiles(_intervals(spark, sf), "diff_seconds", {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def feed_cumulative_top_groups(spark, sf):
    """Top 10 Wards by final running total and their trajectories (running
    total at the end of each date). Running totals over per-(ward, date)
    counts: the window sees one row per date, not one per incident."""
    daily = group_count(incidents(spark, sf, ["ward", "incident_date"]), ["ward", "incident_date"])
    w = Window.partitionBy("ward").orderBy("incident_date").rowsBetween(Window.unboundedPreceding, 0)
    run = daily.withColumn("running_total", F.sum("count").over(w))
    top = topk(daily.groupBy("ward").agg(F.sum("count").alias("total")), [F.desc("total"), F.asc("ward")], 10)
    return run.join(F.broadcast(top.select("ward")), "ward", "left_semi").select("ward", "incident_date", "running_total")


def feed_result_reorder(spark, sf):
    g = feed_rate_vs_volume(spark, sf)
    return topk(g, [F.desc("arrest_rate"), F.asc("district")], 10)


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("feed_") and callable(fn)}


_OK = ", ".join(ORDER_KEYS)
_IV = INC_GAPS + f""", iv AS (SELECT (epoch_us(incident_date) - epoch_us(lag(incident_date) OVER
    (PARTITION BY district ORDER BY incident_date, {_OK}))) / 1000000.0 AS diff_seconds FROM gaps)
"""
_IV = _IV.replace("\n, iv", ",\niv")

ORACLE = {
    "feed_yearly": INC + "SELECT CAST(year(incident_date) AS INTEGER) AS year, count(*) AS count FROM incidents GROUP BY 1",
    "feed_monthly": INC + "SELECT CAST(month(incident_date) AS INTEGER) AS month, count(*) AS count FROM incidents GROUP BY 1",
    "feed_hourly": with_sql(TIMED_SQL) + "SELECT CAST(hour(incident_ts) AS INTEGER) AS hour, count(*) AS count FROM timed GROUP BY 1",
    "feed_top_categories": INC + """
SELECT * FROM (SELECT 'district' AS feed, CAST(district AS VARCHAR) AS value, count(*) AS count FROM incidents
               GROUP BY district ORDER BY count DESC, district LIMIT 15)
UNION ALL SELECT * FROM (SELECT 'location', location_description, count(*) AS count FROM incidents
               GROUP BY location_description ORDER BY count DESC, location_description LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'type', primary_type, count(*) AS count FROM incidents
               GROUP BY primary_type ORDER BY count DESC, primary_type LIMIT 10)""",
    "feed_boolean_share": INC + """SELECT 'arrest' AS flag, CAST(arrest AS VARCHAR) AS value, count(*) AS count FROM incidents GROUP BY 2
UNION ALL SELECT 'domestic', CAST(domestic AS VARCHAR), count(*) FROM incidents GROUP BY 2""",
    "feed_rate_vs_volume": INC + """SELECT district, count(*) FILTER (WHERE arrest) / count(*) * 100 AS arrest_rate,
        count(*) AS count FROM incidents GROUP BY 1""",
    "feed_interval_hist": _IV + f"""
, x AS (SELECT diff_seconds FROM iv WHERE diff_seconds IS NOT NULL),
st AS (SELECT min(diff_seconds) AS lo, max(diff_seconds) AS hi FROM x),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((diff_seconds - lo) / ((hi - lo) / {BINS})), {BINS - 1}) END AS INTEGER) AS bin
      FROM x, st)
SELECT g.bin, round(lo + g.bin * (hi - lo) / {BINS}, 6) AS bin_start, round(lo + (g.bin + 1) * (hi - lo) / {BINS}, 6) AS bin_end,
       coalesce(c.count, 0) AS count
FROM (SELECT CAST(unnest(range(0, {BINS})) AS INTEGER) AS bin) g CROSS JOIN st
LEFT JOIN (SELECT bin, count(*) AS count FROM b GROUP BY bin) c ON g.bin = c.bin""".replace("\n, x AS", ",\nx AS", 1),
    "feed_interval_box": _IV + """SELECT min(diff_seconds) AS min, quantile_cont(diff_seconds, 0.25) AS q1,
        quantile_cont(diff_seconds, 0.5) AS median, quantile_cont(diff_seconds, 0.75) AS q3, max(diff_seconds) AS max
        FROM iv WHERE diff_seconds IS NOT NULL""",
    "feed_cumulative_top_groups": with_sql(INCIDENTS_SQL,
        "d AS (SELECT ward, incident_date, count(*) AS count FROM incidents GROUP BY 1, 2)") + """
SELECT ward, incident_date, CAST(sum(count) OVER (PARTITION BY ward ORDER BY incident_date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
FROM d WHERE ward IN (SELECT ward FROM d GROUP BY ward ORDER BY sum(count) DESC, ward LIMIT 10)""",
    "feed_result_reorder": INC + """SELECT district, count(*) FILTER (WHERE arrest) / count(*) * 100 AS arrest_rate,
        count(*) AS count FROM incidents GROUP BY 1 ORDER BY arrest_rate DESC, district LIMIT 10""",
}
