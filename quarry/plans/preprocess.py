"""Preprocessing chain and its stages as registered queries.

raw incidents (with injected missing values) -> block features -> block
number by mode hierarchy -> location by dominant mode -> District from
Beat -> coordinates by mean hierarchy -> sentinels -> anomaly filter ->
validation. Each stage is a key; its oracle is the same CTE chain cut at
that stage.

The supplied tables have no NULLs, so missing values are injected by a
fixed rule on key columns (the same in Spark and in SQL). The reference
data's sentinels (0 = missing District / Ward / Community Area) exist in
the binding already: ``s_nationkey = 0``, ``c_nationkey = 0``,
``o_custkey % 78 = 0``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.address import (sql_block_number, sql_direction, sql_street_name,
                                      sql_street_type, with_block_features)
from quarry.operators.agg import null_counts
from quarry.operators.impute import (dominant_lookup, fill_dominant, fill_mean, fill_mode, fill_parent,
                                     impute_mode_audit, mean_lookups, mode_lookups, parent_lookup,
                                     sentinel_fill)
from quarry.operators.materialize import ROW, SLICE, numbered
from quarry.operators.quality import anomaly_counts, anomaly_filter, checked_rows, validate_schema, violations
from quarry.plans import params as P
from quarry.plans.bindings import INCIDENTS_SQL, incidents, with_sql

# Missing-value injection of the test binding.
INJECT = {
    "location_description": "order_key % 11 = 0",
    "district": "order_key % 13 = 0",
    "ward": "order_key % 23 = 0",
    "latitude": "order_key % 17 = 0",
    "longitude": "part_key % 19 = 0",
    "block_number": "part_key % 7 = 0",
}
RAW_COLUMNS = ["order_key", "line_number", "part_key", "incident_date", "block", "primary_type",
               "description", "location_description", "arrest", "domestic", "beat", "district",
               "ward", "community_area", "fbi_code", "latitude", "longitude"]
DROPPED = ["fbi_code"]   # the identifier / redundant columns the chain drops
BLOCK_LEVELS = [["street_name", "street_type", "direction", "district"],
                ["street_name", "street_type", "direction"],
                ["street_name", "street_type"]]
LOCATION_KEYS = ["primary_type", "description"]
AUDIT_KEYS = ["order_key", "line_number", "part_key", "beat"]
MEAN_LEVELS = ["community_area", "ward", "district"]
MEAN_SCALE = 8   # exact (order-independent) means of the 2-decimal coordinates
SENTINEL_COLS = ["ward", "community_area", "district"]
# the columns that the source data must have (date, coordinates, District)
REQUIRED = ["incident_date", "latitude", "longitude", "district"]
CRITICAL = ["incident_date", "primary_type", "district", "latitude", "longitude"]


def _inject(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.expr(INJECT[c]), F.lit(None)).otherwise(F.col(c))
                           .cast(df.schema[c].dataType) for c in cols})


def raw(spark, sf) -> DataFrame:
    df = incidents(spark, sf, RAW_COLUMNS)
    return _inject(df, ["location_description", "district", "ward", "latitude", "longitude"])


def stage_features(spark, sf) -> DataFrame:
    df = with_block_features(raw(spark, sf).drop(*DROPPED), "block")
    return _inject(df, ["block_number"])


# The features are written once, with their rows numbered; every lookup of the chain is
# built from that table and written, and one pass streams its rows past the lookups.

def features(spark, sf) -> DataFrame:
    return numbered(stage_features(spark, sf), "features")


def chain(feats: DataFrame, upto: str) -> DataFrame:
    """The written features with the imputations up to ``upto``, in the order block
    number, location, District, coordinates. Eager: the lookups are written."""
    order = ["block", "location", "district", "coordinates"]
    steps = order[:order.index(upto) + 1]
    out = fill_mode(feats, "block_number", BLOCK_LEVELS, mode_lookups(feats, "block_number", BLOCK_LEVELS))
    if "location" in steps:
        out = fill_dominant(out, "location_description", LOCATION_KEYS,
                            dominant_lookup(feats, "location_description", LOCATION_KEYS, 0.8), "Unknown")
    if "district" in steps:
        parents = parent_lookup(feats, "district", "beat")
        out = fill_parent(out, "district", "beat", parents)
    if "coordinates" in steps:
        values = ["latitude", "longitude"]
        # means by District are those of the filled Districts
        repaired = fill_parent(feats.select(SLICE, ROW, "beat", *MEAN_LEVELS, *values), "district", "beat", parents)
        lookups, overall = mean_lookups(repaired, values, MEAN_LEVELS, MEAN_SCALE)
        out = fill_mean(out, values, MEAN_LEVELS, lookups, overall)
        out = out.withColumns({c: F.round(c, 6) for c in values})
    return out.drop(SLICE, ROW)


def stage_block(spark, sf) -> DataFrame:
    return chain(features(spark, sf), "block")


def stage_location(spark, sf) -> DataFrame:
    return chain(features(spark, sf), "location")


def stage_district(spark, sf) -> DataFrame:
    return chain(features(spark, sf), "district")


def stage_coordinates(spark, sf) -> DataFrame:
    return chain(features(spark, sf), "coordinates")


def stage_sentinels(spark, sf) -> DataFrame:
    return sentinel_fill(stage_coordinates(spark, sf), SENTINEL_COLS)


def preprocess_pipeline(spark, sf) -> DataFrame:
    """The whole chain, validated: schema faults raise here, a faulty row raises
    when it is computed. The returned frame is the clean table."""
    clean = anomaly_filter(stage_sentinels(spark, sf), P.ANOMALY_RULES)
    return checked_rows(clean, "incident_date", REQUIRED, CRITICAL, {"district": (1, 31)})


def missing_audit(spark, sf) -> DataFrame:
    """Per imputed feature: NULLs before / after, rows imputed, % before /
    after, distinct values after. Two one-row aggregates over the written features: the raw
    fact is joined and parsed once."""
    feats = ["block_number", "location_description", "district", "latitude", "longitude"]
    before = features(spark, sf)
    after = chain(before, "coordinates")
    b = null_counts(before, feats).select(*[F.col(c).alias(f"b_{c}") for c in feats],
                                          F.lit(1).alias("__k"))
    a = after.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"a_{c}") for c in feats],
                  *[F.count_distinct(c).alias(f"d_{c}") for c in feats]).withColumn("__k", F.lit(1))
    j = b.join(a, "__k")
    stack = F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"),
        F.col(f"b_{c}").alias("null_before"),
        F.col(f"a_{c}").alias("null_after"),
        (F.col(f"b_{c}") - F.col(f"a_{c}")).alias("imputed"),
        F.round(F.col(f"b_{c}") / F.col("rows") * 100, 4).alias("null_pct_before"),
        F.round(F.col(f"a_{c}") / F.col("rows") * 100, 4).alias("null_pct_after"),
        F.col(f"d_{c}").alias("distinct_after")) for c in feats]))
    return j.select(stack.alias("s")).select("s.*")


def impute_mode_two_level(spark, sf) -> DataFrame:
    """Two-level re-run with its row-level audit: each row's value and whether
    it is original, imputed or still missing."""
    _, audit = impute_mode_audit(features(spark, sf), "block_number",
                                 BLOCK_LEVELS[:2], AUDIT_KEYS)
    return audit


def anomaly_report(spark, sf) -> DataFrame:
    return anomaly_counts(stage_sentinels(spark, sf), P.ANOMALY_RULES,
                          coordinate_cols=("latitude", "longitude"), date_col="incident_date",
                          min_year=P.MIN_YEAR)


def validation_violations(spark, sf) -> DataFrame:
    """What validation finds on the raw data; absent columns raise."""
    df = raw(spark, sf)
    validate_schema(df, "incident_date", REQUIRED)
    return violations(df, CRITICAL, {"district": (1, 24)})


QUERIES = {
    "impute_mode_hierarchy": stage_block,
    "impute_mode_two_level": impute_mode_two_level,
    "impute_dominant_mode": stage_location,
    "impute_from_parent": stage_district,
    "impute_mean_hierarchy": stage_coordinates,
    "sentinel_fill": stage_sentinels,
    "preprocess_pipeline": preprocess_pipeline,
    "missing_audit": missing_audit,
    "anomaly_counts": anomaly_report,
    "validate_frame": validation_violations,
}


# --- oracle: the same chain as CTEs ---------------------------------------

def _null_if(col: str) -> str:
    return f"CASE WHEN {INJECT[col]} THEN NULL ELSE {col} END AS {col}"


_KEEP = [c for c in RAW_COLUMNS if c not in DROPPED]
_RAW_SELECT = ", ".join(_null_if(c) if c in INJECT else c for c in _KEEP)

CTES = [
    INCIDENTS_SQL,
    f"raw AS (SELECT {_RAW_SELECT} FROM incidents)",
    f"""feat AS (SELECT *, CASE WHEN {INJECT['block_number']} THEN NULL ELSE {sql_block_number('block')} END
          AS block_number, {sql_direction('block')} AS direction, {sql_street_type('block')} AS street_type,
          {sql_street_name('block')} AS street_name FROM raw)""",
    """bc AS (SELECT street_name, street_type, direction, district, block_number, count(*) AS n
          FROM feat WHERE block_number IS NOT NULL GROUP BY ALL)""",
    """m1 AS (SELECT street_name, street_type, direction, district, block_number AS b1 FROM (
          SELECT *, row_number() OVER (PARTITION BY street_name, street_type, direction, district
                                       ORDER BY n DESC, block_number) AS rn FROM bc) WHERE rn = 1)""",
    """m2 AS (SELECT street_name, street_type, direction, block_number AS b2 FROM (
          SELECT *, row_number() OVER (PARTITION BY street_name, street_type, direction
                                       ORDER BY n DESC, block_number) AS rn
          FROM (SELECT street_name, street_type, direction, block_number, sum(n) AS n FROM bc GROUP BY ALL))
          WHERE rn = 1)""",
    """m3 AS (SELECT street_name, street_type, block_number AS b3 FROM (
          SELECT *, row_number() OVER (PARTITION BY street_name, street_type ORDER BY n DESC, block_number) AS rn
          FROM (SELECT street_name, street_type, block_number, sum(n) AS n FROM bc GROUP BY ALL)) WHERE rn = 1)""",
    """blk AS (SELECT f.* REPLACE (CAST(coalesce(f.block_number, m1.b1, m2.b2, m3.b3) AS INTEGER) AS block_number)
          FROM feat f
          LEFT JOIN m1 ON f.street_name = m1.street_name AND f.street_type = m1.street_type
                      AND f.direction = m1.direction AND f.district = m1.district
          LEFT JOIN m2 ON f.street_name = m2.street_name AND f.street_type = m2.street_type
                      AND f.direction = m2.direction
          LEFT JOIN m3 ON f.street_name = m3.street_name AND f.street_type = m3.street_type)""",
    """lm AS (SELECT primary_type, description, location_description AS loc FROM (
          SELECT *, row_number() OVER (PARTITION BY primary_type, description ORDER BY n DESC, location_description) AS rn,
                 sum(n) OVER (PARTITION BY primary_type, description) AS tot
          FROM (SELECT primary_type, description, location_description, count(*) AS n FROM blk
                WHERE location_description IS NOT NULL GROUP BY ALL))
          WHERE rn = 1 AND n / tot >= 0.8)""",
    """loc AS (SELECT b.* REPLACE (coalesce(b.location_description, lm.loc, 'Unknown') AS location_description)
          FROM blk b LEFT JOIN lm ON b.primary_type = lm.primary_type AND b.description = lm.description)""",
    """dm AS (SELECT beat, district AS d FROM (
          SELECT beat, district, row_number() OVER (PARTITION BY beat ORDER BY count(*) DESC, district) AS rn
          FROM loc WHERE district IS NOT NULL AND district <> 0 GROUP BY beat, district) WHERE rn = 1)""",
    """dist AS (SELECT l.* REPLACE (CASE WHEN l.district IS NULL OR l.district = 0 THEN dm.d ELSE l.district END
                                 AS district)
          FROM loc l LEFT JOIN dm ON l.beat = dm.beat)""",
    "base AS (SELECT * FROM dist WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
    """ca AS (SELECT community_area, avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE AS la, avg(CAST(longitude AS DECIMAL(38,8)))::DOUBLE AS lo FROM base
          WHERE community_area IS NOT NULL AND community_area <> 0 GROUP BY 1)""",
    "wa AS (SELECT ward, avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE AS la, avg(CAST(longitude AS DECIMAL(38,8)))::DOUBLE AS lo FROM base WHERE ward IS NOT NULL AND ward <> 0 GROUP BY 1)",
    """di AS (SELECT district, avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE AS la, avg(CAST(longitude AS DECIMAL(38,8)))::DOUBLE AS lo FROM base
          WHERE district IS NOT NULL AND district <> 0 GROUP BY 1)""",
    "gl AS (SELECT avg(CAST(latitude AS DECIMAL(38,8)))::DOUBLE AS la, avg(CAST(longitude AS DECIMAL(38,8)))::DOUBLE AS lo FROM base)",
    """geo AS (SELECT d.* REPLACE (round(coalesce(d.latitude, ca.la, wa.la, di.la, gl.la), 6) AS latitude,
                                  round(coalesce(d.longitude, ca.lo, wa.lo, di.lo, gl.lo), 6) AS longitude)
          FROM dist d LEFT JOIN ca ON d.community_area = ca.community_area LEFT JOIN wa ON d.ward = wa.ward
          LEFT JOIN di ON d.district = di.district CROSS JOIN gl)""",
    """sent AS (SELECT * REPLACE (
          CASE WHEN ward IS NULL OR ward = 0 THEN -1 ELSE ward END AS ward,
          CASE WHEN community_area IS NULL OR community_area = 0 THEN -1 ELSE community_area END AS community_area,
          CASE WHEN district IS NULL OR district = 0 THEN -1 ELSE district END AS district) FROM geo)""",
]


def _upto(name: str) -> str:
    idx = next(i for i, c in enumerate(CTES) if c.strip().startswith(f"{name} AS"))
    return with_sql(*CTES[: idx + 1])


_R = P.ANOMALY_RULES
_BOX = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in _R.items())
_FEATS = ["block_number", "location_description", "district", "latitude", "longitude"]


def _audit_sql() -> str:
    parts = []
    for c in _FEATS:
        parts.append(f"""SELECT '{c}' AS feature, b.n AS null_before, a.n AS null_after, b.n - a.n AS imputed,
  round(b.n / a.rows * 100, 4) AS null_pct_before, round(a.n / a.rows * 100, 4) AS null_pct_after,
  a.d AS distinct_after
FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) AS n FROM feat) b,
     (SELECT count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS n, count(DISTINCT {c}) AS d FROM geo) a""")
    return _upto("sent") + "\nUNION ALL\n".join(parts)


def _anomaly_sql() -> str:
    la, lo = _R["latitude"], _R["longitude"]
    rules = {
        "invalid_coordinates": f"latitude IS NOT NULL AND (latitude < {la[0]} OR latitude > {la[1]} "
                               f"OR longitude < {lo[0]} OR longitude > {lo[1]})",
    }
    for c in ("district", "ward", "community_area"):
        rules[f"invalid_{c}"] = f"{c} IS NOT NULL AND ({c} < {_R[c][0]} OR {c} > {_R[c][1]})"
    rules["suspicious_dates"] = f"year(incident_date) < {P.MIN_YEAR}"
    cnt = ",\n  ".join(f"count(*) FILTER (WHERE {r}) AS {n}" for n, r in rules.items())
    anyf = " OR ".join(f"coalesce({r}, false)" for r in rules.values())
    raw_sum = " + ".join(rules)
    return _upto("sent") + f"""SELECT *, {raw_sum} AS raw_sum,
  round(({raw_sum}) / total_rows * 100, 4) AS anomaly_pct,
  CASE WHEN {raw_sum} = 0 THEN 'no structural anomalies' ELSE 'structural anomalies detected' END AS verdict
FROM (SELECT count(*) AS total_rows, {cnt},
  count(*) FILTER (WHERE {anyf}) AS rows_with_any_fault FROM sent)"""


def _violations_sql() -> str:
    checks = {f"null_{c}": f"{c} IS NULL" for c in CRITICAL}
    checks["range_district"] = "district IS NOT NULL AND NOT (district BETWEEN 1 AND 24)"
    checks["any_violation"] = " OR ".join(f"({v})" for v in checks.values())
    parts = [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations FROM raw" for n, c in checks.items()]
    parts.append("SELECT 'total_rows' AS rule, count(*) AS violations FROM raw")
    return _upto("raw") + "\nUNION ALL\n".join(parts)


def _two_level_sql() -> str:
    keys = ", ".join(f"f.{k}" for k in AUDIT_KEYS)
    return _upto("m2") + f"""
  SELECT {keys}, CAST(coalesce(f.block_number, m1.b1, m2.b2) AS INTEGER) AS value,
         CASE WHEN f.block_number IS NOT NULL THEN 'original'
              WHEN coalesce(m1.b1, m2.b2) IS NOT NULL THEN 'imputed' ELSE 'missing' END AS status
  FROM feat f
  LEFT JOIN m1 ON f.street_name = m1.street_name AND f.street_type = m1.street_type
              AND f.direction = m1.direction AND f.district = m1.district
  LEFT JOIN m2 ON f.street_name = m2.street_name AND f.street_type = m2.street_type
              AND f.direction = m2.direction"""


ORACLE = {
    "impute_mode_hierarchy": _upto("blk") + "SELECT * FROM blk",
    "impute_mode_two_level": _two_level_sql(),
    "impute_dominant_mode": _upto("loc") + "SELECT * FROM loc",
    "impute_from_parent": _upto("dist") + "SELECT * FROM dist",
    "impute_mean_hierarchy": _upto("geo") + "SELECT * FROM geo",
    "sentinel_fill": _upto("sent") + "SELECT * FROM sent",
    "preprocess_pipeline": _upto("sent") + f"SELECT * FROM sent WHERE {_BOX}",
    "missing_audit": _audit_sql(),
    "anomaly_counts": _anomaly_sql(),
    "validate_frame": _violations_sql(),
}
