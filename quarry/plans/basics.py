"""Registered queries for the single operators (sources, sinks, columns,
scalars, joins, aggregations, windows, sorts and sets)."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.address import (block_number, direction, sql_block_number, sql_direction,
                                      sql_street_name, sql_street_type, street_name, street_type)
from quarry.functions.calendar import (derive_calendar, derive_time_features, geo_grid,
                                       weekend_label)
from quarry.functions.formatting import format_percent, ratio
from quarry.operators.agg import (SKETCH_ERROR, conditional_counts, distinct_counts, duplicate_rows,
                                  global_aggregate, group_count, group_mean, group_mode,
                                  heatmap_pivot, long_values, null_counts, null_percent)
from quarry.operators.joins import attach_scalar, lookup_join, semi_join_top, settled
from quarry.operators.materialize import scratch_table
from quarry.operators.quality import anomaly_filter, collapse_top_categories
from quarry.operators.windows import (cumulative_sum, dense_rank_all, moving_average, rank_prefix,
                                      share_of_partition, top_per_group, topk)
from quarry.plans import params as P
from quarry.plans.bindings import (INCIDENTS_SQL, TIMED_SQL, district_counts, incidents, timed_incidents,
                                   with_sql)
from quarry.plans.preprocess import INJECT
from quarry.plans.preprocess import raw as raw_incidents
from quarry.sources.io import VersionedTable, scan_csv, scan_csv_checked, sink_csv, sink_parquet
from quarry.sources.tables import read_table

INC = with_sql(INCIDENTS_SQL)
TIMED = with_sql(TIMED_SQL)
KEYS = ["order_key", "line_number", "part_key", "beat"]
_K = ", ".join(KEYS)


def _scratch(spark, label: str) -> str:
    return scratch_table(spark, label)


# Which lines of the 22-field file are broken, by order_key % 50.
BAD_LINES = {"id": 0, "short": 1, "long": 2, "date": 3}


# --- sources and sinks ----------------------------------------------------

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])


def q_scan_csv(spark, sf):
    path = _scratch(spark, "orders-csv")
    (read_table(spark, sf, "orders").write.mode("overwrite").option("header", True).option("sep", ";")
     .option("timestampNTZFormat", "MM/dd/yyyy hh:mm:ss a").csv(path))
    return scan_csv(spark, path, schema=ORDERS_SCHEMA)


def q_scan_parquet(spark, sf):
    df = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"])
    return df.filter(F.col("l_quantity") > 25)   # PushedFilters + narrow ReadSchema


def q_sink_parquet(spark, sf):
    path = _scratch(spark, "incidents-parquet")
    sink_parquet(incidents(spark, sf, KEYS + ["incident_date", "district"]), path)
    return spark.read.parquet(path)


def q_sink_csv(spark, sf):
    path = _scratch(spark, "result-csv")
    res = group_count(incidents(spark, sf, ["district", "domestic"]).filter(F.col("domestic")), ["district"])
    sink_csv(res, path)
    schema = T.StructType([T.StructField("district", T.IntegerType()), T.StructField("count", T.LongType())])
    return spark.read.option("header", True).schema(schema).csv(path)


def q_scan_csv_rejected(spark, sf):
    """Incidents written in the 22-field layout, some lines broken by a key rule, and read
    back: lines by part and number of fields, with the sum of the clean IDs."""
    path = _scratch(spark, "incidents-csv")
    kind = F.col("order_key") % 50
    stamp = F.date_format("incident_date", "MM/dd/yyyy hh:mm:ss a")
    fields = [F.when(kind == BAD_LINES["id"], F.lit("n/a")).otherwise((F.col("order_key") % 1_000_000_000).cast("string")),
              F.concat(F.lit("C"), F.col("order_key").cast("string")),
              F.when(kind == BAD_LINES["date"], F.lit("31/31/2020 25:00:00 XM")).otherwise(stamp),
              F.concat(F.lit('"'), F.col("block"), F.lit('"')), F.lit("0110"), F.col("primary_type"), F.col("description"),
              F.col("location_description"), F.col("arrest").cast("string"), F.col("domestic").cast("string"),
              *[F.col(c).cast("int").cast("string") for c in ("beat", "district", "ward", "community_area")], F.col("fbi_code"),
              F.lit("1"), F.lit("2"), F.year("incident_date").cast("string"), stamp, F.col("latitude").cast("string"),
              F.col("longitude").cast("string"), F.lit("(1, 2)")]
    line = (F.when(kind == BAD_LINES["short"], F.concat_ws(";", *fields[:10]))
            .when(kind == BAD_LINES["long"], F.concat_ws(";", *fields, F.lit("extra"))).otherwise(F.concat_ws(";", *fields)))
    incidents(spark, sf).select(line.alias("value")).write.text(path)
    clean, rejected = scan_csv_checked(spark, path, _scratch(spark, "incidents-parsed"), header=False)
    good = clean.agg(F.lit("clean").alias("part"), F.lit(22).alias("fields"), F.count(F.lit(1)).alias("count"),
                     F.sum(F.col("ID").cast("long")).alias("id_sum"))
    bad = rejected.groupBy(F.lit("rejected").alias("part"), F.size(F.split("line", ";")).alias("fields")).agg(
        F.count(F.lit(1)).alias("count"), F.lit(None).cast("long").alias("id_sum"))
    return good.unionByName(bad)


def q_in_place_update(spark, sf):
    blocks = VersionedTable(spark, _scratch(spark, "blocks"))
    blocks.commit(incidents(spark, sf, KEYS + ["block"]))
    blocks.rewrite(lambda d: d.withColumn("street_name", street_name("block")))
    return blocks.read()


def q_in_place_update_twice(spark, sf):
    """Two rewrites in a row, the first of them still read after the second."""
    blocks = VersionedTable(spark, _scratch(spark, "blocks"))
    blocks.commit(incidents(spark, sf, KEYS + ["block"]))
    first = blocks.rewrite(lambda d: d.withColumn("street_name", street_name("block")))
    pinned = blocks.read()
    second = blocks.rewrite(lambda d: d.where("beat % 2 = 0").withColumn("street_name", F.lower("street_name")))
    return (pinned.withColumn("version", F.lit(first)).unionByName(blocks.read().withColumn("version", F.lit(second)))
            .select("version", *KEYS, "street_name"))


# --- columns and predicates --------------------------------------------------

def q_drop_columns(spark, sf):
    return incidents(spark, sf, KEYS + ["district", "ward", "latitude", "longitude"]).drop(
        "latitude", "longitude", "no_such_column")


def q_derive_calendar(spark, sf):
    return derive_calendar(timed_incidents(spark, sf).select("incident_id", "incident_ts"), "incident_ts")


def q_derive_time_features(spark, sf):
    return derive_time_features(timed_incidents(spark, sf).select("incident_id", "incident_ts"), "incident_ts")


def q_geo_grid(spark, sf):
    return incidents(spark, sf, KEYS + ["latitude", "longitude"]).withColumn(
        "geo_grid", geo_grid("latitude", "longitude", 0.01))


def q_flag_weekend(spark, sf):
    return incidents(spark, sf, KEYS + ["incident_date"]).withColumn("is_weekend", weekend_label("incident_date"))


def _predicate():
    c = F.col
    return (((c("primary_type").isin("PROMO", "LARGE") & ~c("location_description").isin("Brand#1", "Brand#2"))
             | (c("latitude").between(20000, 30000) & c("arrest")))
            & (c("incident_date") >= F.lit("1996-01-01").cast("timestamp_ntz"))
            & (c("incident_date") < F.lit("1998-01-01").cast("timestamp_ntz"))
            & c("district").isNotNull())


def q_filter_predicates(spark, sf):
    return incidents(spark, sf, KEYS + ["primary_type", "location_description", "latitude", "arrest",
                                        "incident_date", "district"]).filter(_predicate())


def q_anomaly_filter(spark, sf):
    cols = ["latitude", "longitude", "district", "ward", "community_area"]
    return anomaly_filter(raw_incidents(spark, sf).select(*KEYS, *cols), P.ANOMALY_RULES)


def q_top_n_category_collapse(spark, sf):
    return collapse_top_categories(incidents(spark, sf, KEYS + ["description"]), "description", 10,
                                   out="description_collapsed")


# --- scalar functions ----------------------------------------------------------

def _blocks(spark, sf):
    return incidents(spark, sf, KEYS + ["block"])


def q_parse_block_number(spark, sf):
    return _blocks(spark, sf).withColumn("block_number", block_number("block"))


def q_parse_direction(spark, sf):
    return _blocks(spark, sf).withColumn("direction", direction("block"))


def q_parse_street_type(spark, sf):
    return _blocks(spark, sf).withColumn("street_type", street_type("block"))


def q_parse_street_name(spark, sf):
    return _blocks(spark, sf).withColumn("street_name", street_name("block"))


def q_date_functions(spark, sf):
    ts = F.col("incident_ts")
    return timed_incidents(spark, sf).select(
        "incident_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.hour(ts).alias("h"),
        F.dayofweek(ts).alias("dow"), F.date_format(ts, "yyyy-MM").alias("ym"),
        F.date_format(ts, "yyyy").alias("yyyy"), F.date_format(ts, "E").alias("day_name"),
        F.substring(ts.cast("string"), 1, 4).alias("year_prefix"),
        F.to_timestamp_ntz(F.date_format(ts, "MM/dd/yyyy hh:mm:ss a"), F.lit("MM/dd/yyyy hh:mm:ss a")).alias("parsed"))


def q_conditional_null(spark, sf):
    df = raw_incidents(spark, sf).select(*KEYS, "location_description", "district")
    return df.select(*KEYS,
                     F.coalesce("location_description", F.lit("Unknown")).alias("location_filled"),
                     F.when(F.col("district").isNull(), F.lit(-1)).otherwise(F.col("district")).alias("district_filled"),
                     F.col("district").isNull().alias("district_missing"))


def q_math_cast(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_extendedprice", "l_quantity", "l_discount"])
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        (F.col("l_discount") * 100).alias("discount_pct"),
        F.floor(F.col("l_extendedprice") / 1000).alias("price_band"),
        F.col("l_quantity").cast("int").alias("qty_int"),
        (F.col("l_discount") > 0.05).cast("double").alias("big_discount"))


def q_format_percent(spark, sf):
    g = incidents(spark, sf, ["district", "arrest", "domestic"]).groupBy("district").agg(
        ratio(F.count_if(F.col("arrest") & F.col("domestic")), F.count(F.lit(1)), 100.0).alias("pct"))
    return g.withColumn("label", format_percent("pct")).withColumn("pct", F.round("pct", 6))


# --- joins -----------------------------------------------------------------

def q_join_inner_counts(spark, sf):
    # both counts in one eager aggregate; inner-join semantics: both > 0
    g = district_counts(spark, sf, {"arrests": F.col("arrest"), "domestic": F.col("domestic")})
    return g.filter((F.col("arrests") > 0) & (F.col("domestic") > 0))


def q_join_left_lookup(spark, sf):
    df = incidents(spark, sf, KEYS + ["district", "latitude"])
    means = df.groupBy("district").agg(   # one row per district; exact decimal mean
        F.avg(F.col("latitude").cast("decimal(38,8)")).cast("double").alias("latitude_mean"))
    return lookup_join(df, settled(means, "means"), ["district"], ["latitude_mean"]).withColumn(
        "latitude_mean", F.round("latitude_mean", 6))


def q_join_broadcast_semi(spark, sf):
    return group_count(semi_join_top(incidents(spark, sf, ["primary_type"]), "primary_type", 5),
                       ["primary_type"])


def q_join_cross_scalar(spark, sf):
    counts = group_count(incidents(spark, sf, ["ward"]), ["ward"])
    avg = global_aggregate(counts, {"avg_count": F.avg("count")})
    return attach_scalar(counts, avg).filter(F.col("count") > F.col("avg_count"))


def q_join_restrict_top_groups(spark, sf):
    daily = group_count(incidents(spark, sf, ["ward", "incident_date"]), ["ward", "incident_date"])
    totals = daily.groupBy("ward").agg(F.sum("count").alias("total"))
    top = topk(totals, [F.desc("total"), F.asc("ward")], 10).select("ward")
    return daily.join(F.broadcast(top), "ward", "left_semi")


# --- aggregations ------------------------------------------------------------

def q_group_count(spark, sf):
    return group_count(incidents(spark, sf, ["district", "ward", "fbi_code", "arrest", "domestic"]),
                       ["district", "ward", "fbi_code", "arrest", "domestic"])


def q_filtered_count(spark, sf):
    return conditional_counts(incidents(spark, sf, ["district", "primary_type"]), ["district"],
                              {"count_a": F.col("primary_type") == P.TYPE_A}, require_all=True)


def q_global_aggregate(spark, sf):
    df = incidents(spark, sf, ["latitude", "longitude"])
    dec = "decimal(38,8)"   # exact sums: order-independent means
    return global_aggregate(df, {"rows": F.count(F.lit(1)),
                                 "lat_mean": F.round(F.avg(F.col("latitude").cast(dec)).cast("double"), 6),
                                 "lon_mean": F.round(F.avg(F.col("longitude").cast(dec)).cast("double"), 6)})


def q_group_mean(spark, sf):
    df = incidents(spark, sf, ["community_area", "latitude", "longitude"])
    g = group_mean(df.select("community_area", *[F.col(c).cast("decimal(38,8)").alias(c)
                                                 for c in ("latitude", "longitude")]),
                   ["community_area"], ["latitude", "longitude"])
    return g.select("community_area", F.round(F.col("latitude_mean").cast("double"), 6).alias("latitude_mean"),
                    F.round(F.col("longitude_mean").cast("double"), 6).alias("longitude_mean"))


def q_group_first(spark, sf):
    df = raw_incidents(spark, sf).select("beat", "district")
    return group_mode(df.filter(F.col("district") != 0), ["beat"], "district", out="district")


def q_group_mode(spark, sf):
    return group_mode(incidents(spark, sf, ["primary_type", "description", "location_description"]),
                      ["primary_type", "description"], "location_description", out="location_mode")


def q_group_mode_dominant(spark, sf):
    return group_mode(incidents(spark, sf, ["primary_type", "description", "location_description"]),
                      ["primary_type", "description"], "location_description", out="location_mode",
                      min_share=0.1)


_NULL_COLS = ["location_description", "district", "ward", "latitude", "longitude"]


def q_null_counts(spark, sf):
    return null_counts(raw_incidents(spark, sf), _NULL_COLS)


def q_null_percent(spark, sf):
    return null_percent(raw_incidents(spark, sf), _NULL_COLS).withColumn("null_pct", F.round("null_pct", 6))


_STR_COLS = ["primary_type", "description", "location_description", "fbi_code", "block"]


def q_distinct_count(spark, sf):
    return distinct_counts(incidents(spark, sf, _STR_COLS), _STR_COLS)


def q_distinct_count_sketch(spark, sf):
    """Estimated distinct counts from mergeable sketches beside the exact ones, with
    whether the estimate keeps within four standard errors."""
    df = incidents(spark, sf, _STR_COLS)
    both = attach_scalar(distinct_counts(df, _STR_COLS),
                         distinct_counts(df, _STR_COLS, approx=True).select(*[F.col(c).alias(f"e_{c}") for c in _STR_COLS]))
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(c).alias("distinct"),
        (F.abs(F.col(f"e_{c}") - F.col(c)) <= F.ceil(4 * SKETCH_ERROR * F.col(c))).alias("within")) for c in _STR_COLS]))
    return both.select(rows.alias("r")).select("r.*")


_NUM_COLS = ["beat", "district", "ward", "community_area", "latitude", "longitude"]


def _per_column(df: DataFrame, stats: dict) -> DataFrame:
    """Statistics of every numeric column in one wide aggregate, one row per
    column afterwards."""
    wide = df.agg(*[fn(F.col(c).cast("double")).alias(f"{c}__{s}") for c in _NUM_COLS for s, fn in stats.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
                               for c in _NUM_COLS]))
    return wide.select(rows.alias("r")).select("r.*")


def q_describe_numeric(spark, sf):
    return _per_column(incidents(spark, sf, _NUM_COLS), {
        "count": F.count, "mean": lambda x: F.round(F.avg(x), 4), "stddev": lambda x: F.round(F.stddev_samp(x), 4),
        "min": F.min, "max": F.max})


def q_variance_stddev(spark, sf):
    return _per_column(incidents(spark, sf, _NUM_COLS), {
        "variance": lambda x: F.round(F.var_samp(x), 4), "stddev": lambda x: F.round(F.stddev_samp(x), 4)})


def q_duplicate_rows(spark, sf):
    return duplicate_rows(incidents(spark, sf, ["district", "ward", "primary_type"]))


def q_top_value_ratio(spark, sf):
    df = incidents(spark, sf, _STR_COLS)
    long = long_values(df, _STR_COLS)
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("feature").agg(F.sum("count").alias("total"))   # one row per column
    top = top_per_group(counts, ["feature"], [F.desc("count"), F.asc("value")], 1, out=None)
    top = top.join(F.broadcast(totals), "feature")
    return top.select("feature", F.col("value").alias("top_value"), F.col("count").alias("top_count"),
                      F.round(F.col("count") / F.col("total"), 4).alias("ratio"))


# Fixed values of the binding: the Wards (nation keys), without the last one, so that ``other`` has rows.
HEAT_WARDS = list(range(24))


def q_heatmap_pivot(spark, sf):
    # some rows have no Ward (injected)
    return heatmap_pivot(raw_incidents(spark, sf), "district", "ward", HEAT_WARDS)


# --- windows -------------------------------------------------------------------

def q_win_row_number_top1(spark, sf):
    g = group_count(incidents(spark, sf, ["district", "block"]), ["district", "block"])
    return top_per_group(g, ["district"], [F.desc("count"), F.asc("block")], 1, out=None)


def q_win_rank_top1(spark, sf):
    g = group_count(incidents(spark, sf, ["ward", "primary_type"]), ["ward", "primary_type"])
    return top_per_group(g, ["ward"], [F.desc("count")], 1, kind="rank").withColumn("rank", F.col("rank").cast("int"))


def q_win_dense_rank_global(spark, sf):
    g = group_count(incidents(spark, sf, ["district"]), ["district"])
    return dense_rank_all(g, "count")


def q_win_dense_rank_rows(spark, sf):
    """The dense rank of every incident by its (near-unique) coordinate."""
    return dense_rank_all(raw_incidents(spark, sf).select(*KEYS, "latitude"), "latitude")


def q_win_rank_global_topk(spark, sf):
    g = group_count(incidents(spark, sf, ["beat"]), ["beat"])
    return rank_prefix(g, "count", 5, "rank", ["beat"])


def q_win_moving_avg(spark, sf):
    df = incidents(spark, sf, ["incident_date", "domestic"]).filter(F.col("domestic"))
    monthly = group_count(df.select(F.date_format("incident_date", "yyyy-MM").alias("year_month")), ["year_month"])
    return moving_average(monthly, "year_month", "count", 3).withColumn("moving_avg", F.round("moving_avg", 6))


def q_win_cumulative_sum(spark, sf):
    monthly = group_count(incidents(spark, sf, ["incident_date"]).select(
        F.date_format("incident_date", "yyyy-MM").alias("year_month")), ["year_month"])
    return cumulative_sum(monthly, "year_month", "count", out="cumulative")


def q_win_share_of_partition(spark, sf):
    g = group_count(incidents(spark, sf, ["district", "primary_type"]), ["district", "primary_type"])
    return share_of_partition(g, ["district"], "count", out="share", total="district_total")


# --- sorts, limits, sets --------------------------------------------------------

def q_topk(spark, sf):
    return topk(group_count(incidents(spark, sf, ["beat"]), ["beat"]), [F.desc("count"), F.asc("beat")], 12)


def q_sort_by_key(spark, sf):
    return group_count(incidents(spark, sf, ["fbi_code"]), ["fbi_code"]).orderBy("fbi_code")


def q_union_by_name(spark, sf):
    df = incidents(spark, sf, KEYS + ["arrest", "domestic"])
    a = df.filter(F.col("arrest")).select(*KEYS, F.lit("arrest").alias("subset"))
    d = df.filter(F.col("domestic")).select(F.lit("domestic").alias("subset"), *KEYS)
    return a.unionByName(d)


def q_distinct_rows(spark, sf):
    return incidents(spark, sf, ["district", "ward", "primary_type"]).distinct()


QUERIES = {name[2:]: fn for name, fn in list(globals().items())
           if name.startswith("q_") and callable(fn)}


# --- oracle ------------------------------------------------------------------

_RAW = with_sql(INCIDENTS_SQL, "raw AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {INJECT[c]} THEN NULL ELSE {c} END AS {c}"
    for c in ["location_description", "district", "ward", "latitude", "longitude"]) + ") FROM incidents)")
_BOX = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in P.ANOMALY_RULES.items())
_UNPIV = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM incidents" for c in _NUM_COLS)
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM incidents" for c in _STR_COLS)

_HEAT_SQL = "SELECT district, " + ", ".join(f'count(*) FILTER (WHERE ward = {w}) AS "{w}"' for w in HEAT_WARDS) + f""",
  count(*) FILTER (WHERE ward IS NULL) AS "null", count(*) FILTER (WHERE ward NOT IN ({", ".join(map(str, HEAT_WARDS))})) AS other
FROM (SELECT {", ".join(f"CASE WHEN NOT ({INJECT[c]}) THEN {c} END AS {c}" for c in ("district", "ward"))} FROM incidents)
GROUP BY district"""

ORACLE = {
    "scan_csv": "SELECT * FROM orders",
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 25",
    "sink_parquet": INC + f"SELECT {_K}, incident_date, district FROM incidents",
    "sink_csv": INC + "SELECT district, count(*) AS count FROM incidents WHERE domestic GROUP BY 1",
    "scan_csv_rejected": INC + f"""SELECT part, CAST(fields AS INTEGER) AS fields, count(*) AS count,
        CAST(sum(CASE WHEN part = 'clean' THEN order_key % 1000000000 END) AS BIGINT) AS id_sum FROM (
          SELECT order_key, CASE WHEN order_key % 50 IN ({", ".join(map(str, BAD_LINES.values()))}) THEN 'rejected' ELSE 'clean' END AS part,
                 CASE order_key % 50 WHEN {BAD_LINES["short"]} THEN 10 WHEN {BAD_LINES["long"]} THEN 23 ELSE 22 END AS fields
          FROM incidents) GROUP BY 1, 2""",
    "in_place_update_twice": INC + f"""SELECT CAST(v.version AS INTEGER) AS version, {_K},
        CASE v.version WHEN 2 THEN {sql_street_name('block')} ELSE lower({sql_street_name('block')}) END AS street_name
        FROM incidents, (VALUES (2), (3)) AS v(version) WHERE v.version = 2 OR beat % 2 = 0""",
    "distinct_count_sketch": INC + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS distinct, true AS within FROM incidents" for c in _STR_COLS),
    "win_dense_rank_rows": _RAW + f"SELECT {_K}, latitude, CAST(dense_rank() OVER (ORDER BY latitude DESC NULLS LAST) AS INTEGER) AS rank FROM raw",
    "in_place_update": INC + f"SELECT {_K}, block, {sql_street_name('block')} AS street_name FROM incidents",
"drop_columns": INC + f"SELECT {_K}, district, ward FROM incidents",
    "derive_calendar": TIMED + """SELECT incident_id, incident_ts, incident_ts AS ts,
        CAST(hour(incident_ts) AS INTEGER) AS hour, CAST(year(incident_ts) AS INTEGER) AS year,
        CAST(month(incident_ts) AS INTEGER) AS month, strftime(incident_ts, '%a') AS day_of_week FROM timed""",
    "derive_time_features": TIMED + """SELECT incident_id, incident_ts,
        CAST(year(incident_ts) AS INTEGER) AS crime_year, CAST(month(incident_ts) AS INTEGER) AS crime_month,
        CAST(hour(incident_ts) AS INTEGER) AS crime_hour, CAST(dayofweek(incident_ts) + 1 AS INTEGER) AS crime_dayofweek
        FROM timed""",
    "geo_grid": INC + f"""SELECT {_K}, latitude, longitude,
        CAST(floor(latitude * 100) AS INTEGER) || '_' || CAST(floor(longitude * 100) AS INTEGER) AS geo_grid
        FROM incidents""",
    "flag_weekend": INC + f"""SELECT {_K}, incident_date,
        CASE WHEN dayofweek(incident_date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS is_weekend FROM incidents""",
    "filter_predicates": INC + f"""SELECT {_K}, primary_type, location_description, latitude, arrest, incident_date, district
        FROM incidents WHERE ((primary_type IN ('PROMO', 'LARGE') AND location_description NOT IN ('Brand#1', 'Brand#2'))
          OR (latitude BETWEEN 20000 AND 30000 AND arrest))
          AND incident_date >= TIMESTAMP '1996-01-01' AND incident_date < TIMESTAMP '1998-01-01'
          AND district IS NOT NULL""",
    "anomaly_filter": _RAW + f"SELECT {_K}, latitude, longitude, district, ward, community_area FROM raw WHERE {_BOX}",
    "top_n_category_collapse": INC + f"""SELECT {_K}, description,
        CASE WHEN coalesce(description, 'Unknown') IN (
            SELECT coalesce(description, 'Unknown') AS c FROM incidents GROUP BY 1 ORDER BY count(*) DESC, c LIMIT 10)
          THEN coalesce(description, 'Unknown') ELSE 'OTHER' END AS description_collapsed FROM incidents""",
    "parse_block_number": INC + f"SELECT {_K}, block, {sql_block_number('block')} AS block_number FROM incidents",
    "parse_direction": INC + f"SELECT {_K}, block, {sql_direction('block')} AS direction FROM incidents",
    "parse_street_type": INC + f"SELECT {_K}, block, {sql_street_type('block')} AS street_type FROM incidents",
    "parse_street_name": INC + f"SELECT {_K}, block, {sql_street_name('block')} AS street_name FROM incidents",
    "date_functions": TIMED + """SELECT incident_id, CAST(year(incident_ts) AS INTEGER) AS y,
        CAST(month(incident_ts) AS INTEGER) AS m, CAST(hour(incident_ts) AS INTEGER) AS h,
        CAST(dayofweek(incident_ts) + 1 AS INTEGER) AS dow, strftime(incident_ts, '%Y-%m') AS ym,
        strftime(incident_ts, '%Y') AS yyyy, strftime(incident_ts, '%a') AS day_name,
        substr(CAST(incident_ts AS VARCHAR), 1, 4) AS year_prefix,
        date_trunc('second', incident_ts) AS parsed FROM timed""",
    "conditional_null": _RAW + f"""SELECT {_K}, coalesce(location_description, 'Unknown') AS location_filled,
        CASE WHEN district IS NULL THEN -1 ELSE district END AS district_filled,
        district IS NULL AS district_missing FROM raw""",
    "math_cast": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
        l_discount * 100 AS discount_pct, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS price_band,
        CAST(trunc(l_quantity) AS INTEGER) AS qty_int, CAST(l_discount > 0.05 AS DOUBLE) AS big_discount
        FROM lineitem""",
    "format_percent": INC + """SELECT district, round(pct, 6) AS pct,
        CASE WHEN pct >= 0.1 THEN '~' || printf('%.1f', pct) || '%' WHEN pct > 0 THEN printf('%.5f', pct) || '%'
             ELSE '0.0%' END AS label
        FROM (SELECT district, count(*) FILTER (WHERE arrest AND domestic) / count(*) * 100 AS pct
              FROM incidents GROUP BY 1)""",
    "join_inner_counts": INC + """SELECT a.district, a.arrests, d.domestic
        FROM (SELECT district, count(*) AS arrests FROM incidents WHERE arrest GROUP BY 1) a
        JOIN (SELECT district, count(*) AS domestic FROM incidents WHERE domestic GROUP BY 1) d
        ON a.district = d.district""",
    "join_left_lookup": INC + f"""SELECT i.district, {', '.join('i.' + k for k in KEYS)}, i.latitude,
        round(m.latitude_mean, 6) AS latitude_mean FROM incidents i
        LEFT JOIN (SELECT district, avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE AS latitude_mean FROM incidents GROUP BY 1) m ON i.district = m.district""",
    "join_broadcast_semi": INC + """SELECT primary_type, count(*) AS count FROM incidents
        WHERE primary_type IN (SELECT primary_type FROM incidents GROUP BY 1 ORDER BY count(*) DESC, primary_type LIMIT 5)
        GROUP BY 1""",
    "join_cross_scalar": with_sql(INCIDENTS_SQL, "c AS (SELECT ward, count(*) AS count FROM incidents GROUP BY 1)") +
        "SELECT ward, count, avg_count FROM c, (SELECT avg(count) AS avg_count FROM c) WHERE count > avg_count",
    "join_restrict_top_groups": with_sql(INCIDENTS_SQL,
        "d AS (SELECT ward, incident_date, count(*) AS count FROM incidents GROUP BY 1, 2)") +
        """SELECT * FROM d WHERE ward IN (SELECT ward FROM d GROUP BY ward ORDER BY sum(count) DESC, ward LIMIT 10)""",
    "group_count": INC + "SELECT district, ward, fbi_code, arrest, domestic, count(*) AS count FROM incidents GROUP BY ALL",
    "filtered_count": INC + f"SELECT district, count(*) AS count_a FROM incidents WHERE primary_type = '{P.TYPE_A}' GROUP BY 1",
    "global_aggregate": INC + "SELECT count(*) AS rows, round(avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE, 6) AS lat_mean, "
                               "round(avg(CAST(longitude AS DECIMAL(38,8)))::DOUBLE, 6) AS lon_mean FROM incidents",
    "group_mean": INC + """SELECT community_area, round(avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE, 6) AS latitude_mean,
        round(avg(CAST(longitude AS DECIMAL(38,8)))::DOUBLE, 6) AS longitude_mean FROM incidents GROUP BY 1""",
    "group_first": _RAW + """SELECT beat, district FROM (SELECT beat, district, row_number() OVER
        (PARTITION BY beat ORDER BY count(*) DESC, district) AS rn FROM raw WHERE district IS NOT NULL AND district <> 0
        GROUP BY beat, district) WHERE rn = 1""",
    "group_mode": INC + """SELECT primary_type, description, location_description AS location_mode FROM (
        SELECT primary_type, description, location_description, row_number() OVER (PARTITION BY primary_type, description
          ORDER BY count(*) DESC, location_description) AS rn FROM incidents WHERE location_description IS NOT NULL
        GROUP BY 1, 2, 3) WHERE rn = 1""",
    "group_mode_dominant": INC + """SELECT primary_type, description, location_description AS location_mode FROM (
        SELECT primary_type, description, location_description, count(*) AS n,
          row_number() OVER (PARTITION BY primary_type, description ORDER BY count(*) DESC, location_description) AS rn,
          sum(count(*)) OVER (PARTITION BY primary_type, description) AS tot
        FROM incidents WHERE location_description IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1 AND n / tot >= 0.1""",
    "null_counts": _RAW + "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _NULL_COLS) + " FROM raw",
    "null_percent": _RAW + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 6) AS null_pct FROM raw" for c in _NULL_COLS),
    "distinct_count": INC + "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _STR_COLS) + " FROM incidents",
    "describe_numeric": INC + f"""SELECT feature, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS stddev,
        min(x) AS min, max(x) AS max FROM ({_UNPIV}) GROUP BY feature""",
    "variance_stddev": INC + f"""SELECT feature, round(var_samp(x), 4) AS variance, round(stddev_samp(x), 4) AS stddev
        FROM ({_UNPIV}) GROUP BY feature""",
    "duplicate_rows": INC + """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
        SELECT count(*) AS n FROM incidents GROUP BY district, ward, primary_type)""",
    "top_value_ratio": INC + f"""SELECT feature, value AS top_value, count AS top_count, round(count / total, 4) AS ratio FROM (
        SELECT feature, value, count(*) AS count,
          row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS rn,
          sum(count(*)) OVER (PARTITION BY feature) AS total
        FROM ({_LONG}) GROUP BY 1, 2) WHERE rn = 1""",
    "heatmap_pivot": INC + _HEAT_SQL,
    "win_row_number_top1": INC + """SELECT district, block, count FROM (
        SELECT district, block, count(*) AS count, row_number() OVER (PARTITION BY district ORDER BY count(*) DESC, block) AS rn
        FROM incidents GROUP BY 1, 2) WHERE rn = 1""",
    "win_rank_top1": INC + """SELECT ward, primary_type, count, rank FROM (
        SELECT ward, primary_type, count(*) AS count,
          CAST(rank() OVER (PARTITION BY ward ORDER BY count(*) DESC) AS INTEGER) AS rank
        FROM incidents GROUP BY 1, 2) WHERE rank = 1""",
    "win_dense_rank_global": INC + """SELECT district, count(*) AS count,
        CAST(dense_rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank FROM incidents GROUP BY 1""",
    "win_rank_global_topk": INC + """SELECT * FROM (SELECT beat, count(*) AS count,
        CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank FROM incidents GROUP BY 1) WHERE rank <= 5""",
    "win_moving_avg": INC + """SELECT year_month, count,
        round(avg(count) OVER (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_avg
        FROM (SELECT strftime(incident_date, '%Y-%m') AS year_month, count(*) AS count FROM incidents WHERE domestic GROUP BY 1)""",
    "win_cumulative_sum": INC + """SELECT year_month, count,
        CAST(sum(count) OVER (ORDER BY year_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
        FROM (SELECT strftime(incident_date, '%Y-%m') AS year_month, count(*) AS count FROM incidents GROUP BY 1)""",
    "win_share_of_partition": INC + """SELECT district, primary_type, count(*) AS count,
        CAST(sum(count(*)) OVER (PARTITION BY district) AS BIGINT) AS district_total,
        count(*) / sum(count(*)) OVER (PARTITION BY district) AS share FROM incidents GROUP BY 1, 2""",
    "topk": INC + "SELECT beat, count(*) AS count FROM incidents GROUP BY 1 ORDER BY count DESC, beat LIMIT 12",
    "sort_by_key": INC + "SELECT fbi_code, count(*) AS count FROM incidents GROUP BY 1 ORDER BY 1",
    "union_by_name": INC + f"""SELECT {_K}, 'arrest' AS subset FROM incidents WHERE arrest
        UNION ALL SELECT {_K}, 'domestic' AS subset FROM incidents WHERE domestic""",
    "distinct_rows": INC + "SELECT DISTINCT district, ward, primary_type FROM incidents",
}
