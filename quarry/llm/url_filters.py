"""Operator 6: URL filters by hashed host-suffix and path-prefix expressions.

A rule is (verdict, host, path). Each URL is expanded into the expressions
``host suffix + path prefix`` that have the shape (labels of the host, length
of the path) of some rule, so any rule that fits is among them. Expressions
meet rules on the first 32 bits of their SHA-256; the full digest confirms,
and of the rules that fit the longest wins (then the longer host, then
``block``). Partial aggregation folds the expressions of a URL back into one
row before the only shuffle.

Defined results: a null URL or one without ``://`` has empty host and path
and gets the default verdict; repeated rows are judged each on their own; an
empty table gives an empty result; only the id and URL columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, UPPER, table

# The rules of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(rule, verdict, host_length, digest, prefix) of a rule list."""
    rows = spark.createDataFrame(rules, "verdict string, host string, path string")
    return rows.select(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
                       F.sha2(F.concat("host", "path"), 256).alias("digest")).withColumn("prefix", _short("digest"))


def _short(digest: str) -> Column:
    return F.substring(digest, 1, 8)


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """All expressions of a URL with one of the shapes (labels, path length)."""
    labels = F.split(host, r"\.", -1)
    return F.array_compact(F.array(*[
        F.when((host != "") & (F.size(labels) >= n) & (F.length(path) >= size),
               F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, size)))
        for n, size in shapes]))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict."""
    shapes = sorted({(len(host.split(".")), len(path)) for _, host, path in rules if host})
    url = F.col(url_col)
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"),
                        F.monotonically_increasing_id().alias("row"))
    found = (urls.withColumn("expression", F.explode_outer(expressions(F.col("host"), F.col("path"), shapes)))
             .withColumn("full", F.sha2("expression", 256)).withColumn("short", _short("full")))
    # the rules are a list that the driver already holds, so their size is known
    known = F.broadcast(rule_table(pages.sparkSession, rules))
    fits = found.join(known, (F.col("short") == F.col("prefix")) & (F.col("full") == F.col("digest")), "left")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("length"), "host_length", F.col("verdict"), F.col("rule"))))
    return (fits.groupBy("row", "page_id", "host", "path").agg(best.alias("best"))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), RULES)


QUERIES = {"op6_url_filters": op6_url_filters}
ORACLE = {"op6_url_filters": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                          ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (page_id)
"""}
