"""Binding of the supplied tables to the incident roles.

The incident table of the analytics suite is a wide fact. The supplied
tables stand in for it as a star: one incident per ``lineitem`` row, with
its attributes spread over ``orders``, ``part``, ``supplier`` and
``customer``. Operators only see role columns (``district``,
``primary_type`` ...), so the same code runs on a real incident table.

Scale notes
-----------
* ``incidents(roles=...)`` joins only the dimensions the requested roles
  need. All lineitem foreign keys resolve (TPC-H referential integrity),
  so dropping an unused inner join never changes the row set; the oracle
  SQL uses the full five-way join and checks exactly that.
* No join is hinted. ``orders``/``part``/``customer``/``supplier`` all grow
  with the scale factor, so their size is not bounded; Catalyst picks
  broadcast from file statistics when a side is small and AQE re-plans
  from runtime sizes (and splits skewed partitions) otherwise.
* Column pruning and filter pushdown reach every parquet scan because the
  view is a plain lazy projection over joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.sources.tables import read_table

# Fixed values of the binding (the stand-in literals chosen for the tables).
DIRECTIONS = ["N", "S", "E", "W"]            # by l_suppkey % 4
STREET_TYPES = ["ST", "AVE", "RD", "BLVD"]   # by l_partkey % 4
COMMUNITY_AREA_MODULUS = 78


def _pick(values: list[str], index: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


# role -> (tables needed besides lineitem, column expression)
def _role_columns() -> dict[str, tuple[set[str], Column]]:
    l_supp = F.col("l_suppkey")
    l_part = F.col("l_partkey")
    block = F.concat(
        F.lpad(l_supp.cast("string"), 3, "0"), F.lit("XX "),
        _pick(DIRECTIONS, l_supp % 4), F.lit(" "),
        F.upper(F.col("p_name")), F.lit(" "),
        _pick(STREET_TYPES, l_part % 4),
    )
    return {
        # composite unique key of an incident (tie-break for row windows)
        "order_key": (set(), F.col("l_orderkey")),
        "line_number": (set(), F.col("l_linenumber")),
        "part_key": (set(), l_part),
        "incident_date": ({"orders"}, F.col("o_orderdate")),
        "primary_type": ({"part"}, F.col("p_type")),
        "description": ({"part"}, F.col("p_name")),
        "location_description": ({"part"}, F.col("p_brand")),
        "arrest": (set(), F.col("l_returnflag") == F.lit("R")),
        "domestic": (set(), F.col("l_linestatus") == F.lit("F")),
        "beat": (set(), l_supp),
        "district": ({"supplier"}, F.col("s_nationkey")),
        "ward": ({"orders", "customer"}, F.col("c_nationkey")),
        "community_area": ({"orders"}, F.col("o_custkey") % F.lit(COMMUNITY_AREA_MODULUS)),
        "fbi_code": ({"orders"}, F.col("o_orderpriority")),
        "latitude": (set(), F.col("l_extendedprice")),
        "longitude": (set(), F.col("l_quantity")),
        "block": ({"part"}, block),
    }


ROLES = ("order_key", "line_number", "part_key", "incident_date", "primary_type", "description",
         "location_description", "arrest", "domestic", "beat", "district", "ward",
         "community_area", "fbi_code", "latitude", "longitude", "block")
KEY_ROLES = ("order_key", "line_number", "part_key", "beat", "latitude", "longitude")

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_returnflag", "l_linestatus"]


def incidents(spark: SparkSession, sf_dir: str, roles: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """The incident view with the requested role columns (default: all)."""
    roles = list(roles or ROLES)
    spec = _role_columns()
    unknown = [r for r in roles if r not in spec]
    if unknown:
        raise ValueError(f"unknown roles {unknown}")
    need: set[str] = set()
    for r in roles:
        need |= spec[r][0]
    df = read_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS)
    if "orders" in need:
        orders = read_table(spark, sf_dir, "orders",
                            ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in need:
        part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if "supplier" in need:
        supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
        df = df.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if "customer" in need:
        customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return df.select(*[spec[r][1].alias(r) for r in roles])


def district_counts(spark: SparkSession, sf_dir: str, counts: dict[str, Column]) -> DataFrame:
    """Conditional incident counts per District, aggregated BELOW the supplier
    join (eager aggregation). ``counts`` maps output names to predicates on
    the lineitem-side roles ``arrest`` / ``domestic`` / ``beat``.

    The fact is first counted per Beat (supplier): partial aggregation on the
    map side ships at most one row per (task, supplier), and the join to
    ``supplier`` sees one row per supplier instead of one per incident. The
    result equals counting the joined view."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_returnflag", "l_linestatus"]).select(
        F.col("l_suppkey").alias("beat"),
        (F.col("l_returnflag") == F.lit("R")).alias("arrest"),
        (F.col("l_linestatus") == F.lit("F")).alias("domestic"))
    per_beat = li.groupBy("beat").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    joined = per_beat.join(supplier, F.col("beat") == F.col("s_suppkey"))
    return joined.groupBy(F.col("s_nationkey").alias("district")).agg(
        *[F.sum(n).cast("long").alias(n) for n in counts])


def timed_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with a time of day (``events``): used for hour bands and
    intervals, since ``orders.o_orderdate`` has day precision only."""
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type"]).select(
        F.col("event_id").alias("incident_id"),
        F.col("ts").alias("incident_ts"),
        F.col("event_type").alias("primary_type"),
    )


def severity_lookup(spark: SparkSession, sf_dir: str, leave_out: str = "SMALL") -> DataFrame:
    """Severity lookup by type, derived from the distinct ``p_type`` values
    (all but ``leave_out``, so the anti join has rows). Rank by name order:
    rank 1 is 'critical'."""
    types = (read_table(spark, sf_dir, "part", ["p_type"]).distinct()
             .filter(F.col("p_type") != leave_out))
    # global window over the distinct type list only (a few rows)
    w_rank = F.dense_rank().over(Window.orderBy("p_type"))
    return types.select(
        F.col("p_type").alias("primary_type"),
        w_rank.cast("int").alias("severity_rank"),
    ).withColumn("severity", F.when(F.col("severity_rank") <= 2, "critical")
                 .when(F.col("severity_rank") <= 4, "high").otherwise("normal"))


def district_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District names (``nation``), with a 'central' flag by region 0..1."""
    return read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]).select(
        F.col("n_nationkey").alias("district"),
        F.col("n_name").alias("district_name"),
        (F.col("n_regionkey") == 0).alias("is_central"),
    )


# --- oracle side: the same binding as SQL text (full five-way join) ------

INCIDENTS_SQL = f"""
incidents AS (
  SELECT
    l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS part_key,
    o.o_orderdate AS incident_date, p.p_type AS primary_type, p.p_name AS description,
    p.p_brand AS location_description, (l.l_returnflag = 'R') AS arrest,
    (l.l_linestatus = 'F') AS domestic, l.l_suppkey AS beat, s.s_nationkey AS district,
    c.c_nationkey AS ward, o.o_custkey % {COMMUNITY_AREA_MODULUS} AS community_area,
    o.o_orderpriority AS fbi_code, l.l_extendedprice AS latitude, l.l_quantity AS longitude,
    lpad(CAST(l.l_suppkey AS VARCHAR), 3, '0') || 'XX ' ||
      CASE l.l_suppkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'E' ELSE 'W' END || ' ' ||
      upper(p.p_name) || ' ' ||
      CASE l.l_partkey % 4 WHEN 0 THEN 'ST' WHEN 1 THEN 'AVE' WHEN 2 THEN 'RD' ELSE 'BLVD' END AS block
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

TIMED_SQL = """
timed AS (
  SELECT event_id AS incident_id, ts AS incident_ts, event_type AS primary_type
  FROM events
)"""

SEVERITY_SQL = """
severity AS (
  SELECT primary_type, severity_rank,
         CASE WHEN severity_rank <= 2 THEN 'critical' WHEN severity_rank <= 4 THEN 'high'
              ELSE 'normal' END AS severity
  FROM (SELECT p_type AS primary_type,
               CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS severity_rank
        FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'SMALL'))
)"""

DISTRICTS_SQL = """
districts AS (
  SELECT n_nationkey AS district, n_name AS district_name, (n_regionkey = 0) AS is_central
  FROM nation
)"""


def with_sql(*ctes: str) -> str:
    """``WITH`` prefix for oracle queries."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
