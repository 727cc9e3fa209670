"""Profiling and imbalance queries."""

from __future__ import annotations

from quarry.operators.profile import LABELS, imbalance_analysis, imbalance_frame, profile_table
from quarry.plans.bindings import INCIDENTS_SQL, with_sql
from quarry.plans.preprocess import INJECT
from quarry.plans.preprocess import raw as raw_incidents

PROFILE_COLS = ["incident_date", "primary_type", "location_description", "arrest", "beat", "district",
                "ward", "community_area", "latitude", "longitude"]
EXCLUDE = ["order_key", "line_number", "part_key"]
FORCE_NUMERIC = ["beat", "district", "ward", "community_area", "crime_year", "crime_month", "crime_hour",
                 "crime_dayofweek", "block_number"]
MAX_DISTINCT = 100
TOP_N = 10
GRID = 0.01


def profile(spark, sf):
    return profile_table(raw_incidents(spark, sf).select(*PROFILE_COLS))


def _imbalance(spark, sf):
    work, aux = imbalance_frame(raw_incidents(spark, sf), "incident_date", "latitude", "longitude", GRID)
    return imbalance_analysis(work, EXCLUDE, FORCE_NUMERIC, aux, MAX_DISTINCT, TOP_N)


def imbalance_summary(spark, sf):
    return _imbalance(spark, sf)[0]


def imbalance_top_values(spark, sf):
    return _imbalance(spark, sf)[1]


QUERIES = {"profile_table": profile, "imbalance_summary": imbalance_summary,
           "imbalance_top_values": imbalance_top_values}


# --- oracle ------------------------------------------------------------------

_RAW_CTE = "raw AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {INJECT[c]} THEN NULL ELSE {c} END AS {c}"
    for c in ["location_description", "district", "ward", "latitude", "longitude"]) + ") FROM incidents)"

_DTYPES = {"incident_date": "timestamp_ntz", "primary_type": "string", "location_description": "string",
           "arrest": "boolean", "beat": "bigint", "district": "int", "ward": "int", "community_area": "bigint",
           "latitude": "double", "longitude": "double"}
_NUMERIC = {"beat", "district", "ward", "community_area", "latitude", "longitude"}


_TEXT = {"primary_type", "location_description", "arrest"}


def _profile_sql() -> str:
    parts = []
    for c in PROFILE_COLS:
        num, text = c in _NUMERIC, c in _TEXT
        null = "CAST(NULL AS DOUBLE)"
        mean, sd, var = ((f"round({f}({c}), 4)" if num else null) for f in ("avg", "stddev_samp", "var_samp"))
        mn, mx = ((f"CAST({f}({c}) AS DOUBLE)" if num else null) for f in ("min", "max"))
        distinct = f"count(DISTINCT {c})" if text else "CAST(NULL AS BIGINT)"
        head = (f"""SELECT '{c}' AS feature, '{_DTYPES[c]}' AS dtype, s.rows, s.nulls, round(s.nulls / s.rows * 100, 6) AS null_pct,
  s.distinct, s.mean, s.stddev, s.variance, s.min, s.max, """)
        body = f"""(SELECT count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, {distinct} AS distinct,
             {mean} AS mean, {sd} AS stddev, {var} AS variance, {mn} AS min, {mx} AS max FROM raw) s"""
        if text:
            parts.append(head + f"""t.v AS top_value, t.n AS top_count, round(t.n / s.rows, 4) AS top_ratio FROM {body},
     (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM raw GROUP BY 1 ORDER BY n DESC, v ASC NULLS FIRST LIMIT 1) t""")
        else:
            parts.append(head + "CAST(NULL AS VARCHAR) AS top_value, CAST(NULL AS BIGINT) AS top_count, "
                                f"CAST(NULL AS DOUBLE) AS top_ratio FROM {body}")
    return with_sql(INCIDENTS_SQL, _RAW_CTE) + "\nUNION ALL\n".join(parts)


# the imbalance work frame: raw + geo_grid + crime_* (all columns by type)
_WORK_TYPES = {"order_key": "bigint", "line_number": "int", "part_key": "bigint", "incident_date": "ts",
               "block": "string", "primary_type": "string", "description": "string",
               "location_description": "string", "arrest": "boolean", "domestic": "boolean", "beat": "bigint",
               "district": "int", "ward": "int", "community_area": "bigint", "fbi_code": "string",
               "latitude": "double", "longitude": "double", "geo_grid": "string", "crime_year": "int",
               "crime_month": "int", "crime_hour": "int", "crime_dayofweek": "int"}
_AUX = ["latitude", "longitude", "incident_date"]


def _reason(c: str) -> str:
    t = _WORK_TYPES[c]
    if c in _AUX:
        return "used_for_derived_feature"
    if c in EXCLUDE:
        return "excluded"
    if t in ("string", "boolean"):
        return "categorical"
    if c in FORCE_NUMERIC and t in ("int", "bigint"):
        return "forced_numeric"
    if t in ("int", "bigint"):
        return "low_cardinality_numeric"
    return "skipped_unsupported_type"


_CAND = [c for c in _WORK_TYPES if _reason(c) in ("categorical", "forced_numeric", "low_cardinality_numeric")]
_STATIC = [c for c in _WORK_TYPES if c not in _CAND]
_F = int(round(1 / GRID))


def _imbalance_ctes() -> str:
    work = f"""work AS (SELECT *,
      CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN
        CAST(CAST(floor(latitude * {_F}) AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(floor(longitude * {_F}) AS INTEGER) AS VARCHAR)
      END AS geo_grid,
      CAST(year(incident_date) AS INTEGER) AS crime_year, CAST(month(incident_date) AS INTEGER) AS crime_month,
      CAST(hour(incident_date) AS INTEGER) AS crime_hour, CAST(dayofweek(incident_date) + 1 AS INTEGER) AS crime_dayofweek
    FROM raw)"""
    vc = "vc AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM work GROUP BY 2"
        for c in _CAND) + ")"
    reasons = "reasons AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{_reason(c)}')" for c in _CAND) + \
        ") AS t(feature, reason))"
    ranked = f"""ranked AS (SELECT vc.*, sum(count) OVER (PARTITION BY feature) AS rows,
        count(*) OVER (PARTITION BY feature) AS distinct_count,
        row_number() OVER (PARTITION BY feature ORDER BY count DESC, value ASC NULLS FIRST) AS rank FROM vc)"""
    top = f"""top AS (SELECT r.*, CASE WHEN r.distinct_count <= 1 THEN 'skipped_constant'
          WHEN s.reason = 'low_cardinality_numeric' AND r.distinct_count > {MAX_DISTINCT} THEN 'skipped_high_cardinality_numeric'
          ELSE s.reason END AS analysis_type
        FROM ranked r JOIN reasons s ON r.feature = s.feature WHERE r.rank <= {TOP_N})"""
    return with_sql(INCIDENTS_SQL, _RAW_CTE, work, vc, reasons, ranked, top)


def _label(x: str) -> str:
    case = "CASE " + " ".join(f"WHEN {x} >= {t} THEN '{n}'" for t, n in LABELS)
    return case + " ELSE 'relatively_balanced' END"


_ANALYZED = "analysis_type IN ('categorical', 'forced_numeric', 'low_cardinality_numeric')"


def _imbalance_summary_sql() -> str:
    static = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{_reason(c)}' AS analysis_type, CAST(NULL AS BIGINT) AS distinct_count, "
        "CAST(NULL AS VARCHAR) AS top_value, CAST(NULL AS BIGINT) AS top_count, CAST(NULL AS DOUBLE) AS dominance_ratio, "
        "CAST(NULL AS DOUBLE) AS top_n_ratio, 'skipped' AS imbalance_label" for c in _STATIC)
    return _imbalance_ctes() + f"""
SELECT feature, analysis_type, distinct_count,
  CASE WHEN {_ANALYZED} THEN top_value END AS top_value,
  CASE WHEN {_ANALYZED} THEN top_count END AS top_count,
  CASE WHEN {_ANALYZED} THEN round(dominance_ratio, 6) END AS dominance_ratio,
  CASE WHEN {_ANALYZED} THEN top_n_ratio END AS top_n_ratio,
  CASE WHEN {_ANALYZED} THEN {_label('dominance_ratio')} ELSE 'skipped' END AS imbalance_label
FROM (SELECT feature, analysis_type, distinct_count,
        max(CASE WHEN rank = 1 THEN value END) AS top_value, max(CASE WHEN rank = 1 THEN count END) AS top_count,
        max(CASE WHEN rank = 1 THEN count END) / max(rows) AS dominance_ratio,
        round(sum(count) / max(rows), 6) AS top_n_ratio
      FROM top GROUP BY feature, analysis_type, distinct_count)
UNION ALL {static}"""


ORACLE = {
    "profile_table": _profile_sql(),
    "imbalance_summary": _imbalance_summary_sql(),
    "imbalance_top_values": _imbalance_ctes() + f"""SELECT feature, value, count, round(count / rows, 6) AS ratio,
        CAST(rank AS INTEGER) AS rank FROM top WHERE {_ANALYZED}""",
}
