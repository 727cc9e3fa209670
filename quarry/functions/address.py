"""Features parsed from a free-text block address such as ``001XX N STATE ST``.

All built-in regex functions (JVM side, whole-stage codegen); no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Address patterns and sentinels (must equal the source rules).
NUMBER_PATTERN = r"^(\d+)"
DIRECTION_PATTERN = r"\b(N|S|E|W)\b"
STREET_TYPE_PATTERN = r"\b(ST|AVE|AV|RD|BLVD|DR|LN|CT|PL|PKWY|HWY|TER|CIR|WAY)\b\.?$"
NUMBER_PREFIX_PATTERN = r"^\d+XX\s*"
DIRECTION_TOKEN_PATTERN = r"\b(N|S|E|W)\b\s*"
UNKNOWN = "UNKNOWN"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _unknown_if_empty(c: Column) -> Column:
    return F.when(c == "", F.lit(UNKNOWN)).otherwise(c)


def block_number(block: str | Column) -> Column:
    """Leading digits as int; no match -> NULL (guard: ANSI cast of '' fails)."""
    raw = F.regexp_extract(_c(block), NUMBER_PATTERN, 1)
    return F.when(raw != "", raw.cast("int"))


def direction(block: str | Column) -> Column:
    """First standalone N/S/E/W; '' -> UNKNOWN; NULL stays NULL."""
    return _unknown_if_empty(F.regexp_extract(_c(block), DIRECTION_PATTERN, 1))


def street_type(block: str | Column) -> Column:
    """Trailing street type (case-sensitive match, upper-cased); '' -> UNKNOWN."""
    return _unknown_if_empty(F.upper(F.regexp_extract(_c(block), STREET_TYPE_PATTERN, 1)))


def street_name(block: str | Column) -> Column:
    """Block minus number prefix, every direction token and the trailing
    type, trimmed; NULL or '' -> UNKNOWN."""
    name = F.trim(
        F.regexp_replace(
            F.regexp_replace(
                F.regexp_replace(_c(block), NUMBER_PREFIX_PATTERN, ""),
                DIRECTION_TOKEN_PATTERN, ""),
            STREET_TYPE_PATTERN, ""))
    return F.when(name.isNull() | (name == ""), F.lit(UNKNOWN)).otherwise(name)


def with_block_features(df: DataFrame, block_col: str = "block") -> DataFrame:
    """Add ``block_number, direction, street_type, street_name``."""
    return df.withColumns({
        "block_number": block_number(block_col),
        "direction": direction(block_col),
        "street_type": street_type(block_col),
        "street_name": street_name(block_col),
    })


# --- oracle side (DuckDB / RE2 spelling of the same rules) ----------------

def sql_block_number(col: str) -> str:
    return (f"CASE WHEN regexp_extract({col}, '^(\\d+)', 1) <> '' "
            f"THEN CAST(regexp_extract({col}, '^(\\d+)', 1) AS INTEGER) END")


def sql_direction(col: str) -> str:
    return (f"CASE WHEN regexp_extract({col}, '\\b(N|S|E|W)\\b', 1) = '' THEN 'UNKNOWN' "
            f"ELSE regexp_extract({col}, '\\b(N|S|E|W)\\b', 1) END")


def sql_street_type(col: str) -> str:
    ext = f"upper(regexp_extract({col}, '{STREET_TYPE_PATTERN}', 1))"
    return f"CASE WHEN {ext} = '' THEN 'UNKNOWN' ELSE {ext} END"


def sql_street_name(col: str) -> str:
    name = (f"trim(regexp_replace(regexp_replace(regexp_replace({col}, "
            f"'{NUMBER_PREFIX_PATTERN}', '', 'g'), '{DIRECTION_TOKEN_PATTERN}', '', 'g'), "
            f"'{STREET_TYPE_PATTERN}', '', 'g'))")
    return f"CASE WHEN {name} IS NULL OR {name} = '' THEN 'UNKNOWN' ELSE {name} END"
