"""Operator 5: exact dedup with a heavy-hitter split.

Each row is reduced to the SHA-256 of its normalised text. A frequent-items
sketch (the Misra-Gries family, ``approx_top_k``) names the digests that may
be frequent; their exact counts and winners are at most ``heavy`` rows, so
they are broadcast and their copies resolved where they are read. The other
digests, none of which holds more than a few ten-thousandths of the rows,
meet in one ordinary shuffle.

Defined results: null text counts as empty; null ids sort last; of repeated
rows with the same id and text exactly one stays; an empty table gives an
empty result; only the id and text columns are read, so extra columns never
clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, one_space, table


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the text with white space runs as one space."""
    text = one_space(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def frequent_winners(rows: DataFrame, heavy: int = 1000, tracked: int = 10_000) -> DataFrame:
    """At most ``heavy`` rows (digest, winner, n): the verified count and the
    smallest row of every digest that the sketch calls frequent."""
    h = F.xxhash64("digest")
    # the sketch counts 64-bit hashes; the counts below are of whole digests
    top = (rows.agg(F.expr(f"approx_top_k(xxhash64(digest), {int(heavy)}, {int(tracked)})").alias("top"))
           .select(F.explode("top").alias("t")).select(F.col("t.item").alias("h")))
    return (rows.join(F.broadcast(top), h == F.col("h"), "left_semi")
            .groupBy("digest").agg(F.min("me").alias("winner"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").orderBy(F.desc("n"), "digest").limit(heavy))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                heavy: int = 1000, tracked: int = 10_000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = scratch.save(
        text_digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    rows = rows.withColumn("me", F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row"))
    winners = scratch.save(frequent_winners(rows, heavy, tracked), "winners")
    frequent = rows.join(F.broadcast(winners), "digest")
    group = W.partitionBy("digest")
    rest = (rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
            .withColumns({"winner": F.min("me").over(group), "n": F.count(F.lit(1)).over(group)}))
    return frequent.unionByName(rest).select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("me.row") == F.col("winner.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLE = {"op5_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""}
