"""Operator 2: packing into optimal length buckets.

Lengths are word counts. A document longer than ``max_length`` is laid out as
consecutive pieces, so the global histogram of piece lengths has at most
``max_length`` rows; it is collected, and dynamic programming over it chooses
the ``buckets`` upper bounds that minimise padding exactly. Inside a bucket of
bound b a batch holds ``token_budget // b`` pieces. Pieces are numbered within
their bucket in the order of a keyed hash: row numbers inside hash slices of
bounded size plus the slices' prefix counts, so no bucket meets in one task.
All batches of a bucket but its last are full.

Only lengths are read and shuffled; the result is a layout of spans (start and
length in words) into the documents. Defined results: null, empty and blank
texts have one span of length 0 in no batch; repeated rows are laid out each
on their own; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, table, word_count

MAX_LENGTH = 2048
BUCKETS = 12
TOKEN_BUDGET = 16_384
SEED = 17


def bucket_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``lengths`` ascend. The padded size of a bucket over lengths i+1..j is
    their count times length j; the sum is minimised over all cuts."""
    if not lengths:
        return []
    size = np.asarray(lengths, dtype=np.int64)
    upto = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])
    n = len(size)
    # price[i, j]: one bucket over lengths i+1..j+1 (0-based cut i <= j)
    price = np.where(np.arange(n)[:, None] <= np.arange(n)[None, :], (upto[1:][None, :] - upto[:-1][:, None]) * size[None, :],
                     np.iinfo(np.int64).max // 4)
    best = price[0].copy()
    cuts = []
    for _ in range(1, min(buckets, n)):
        # a further bucket starts behind length i: best[i] + price[i + 1, j]
        options = best[:-1, None] + price[1:, :]
        at = options.argmin(axis=0)
        value = options[at, np.arange(n)]
        better = value < best
        cuts.append(np.where(better, at, -1))
        best = np.where(better, value, best)
    bounds, j = [int(size[-1])], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            j = int(cut[j])
            bounds.append(int(size[j]))
    return bounds[::-1]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH) -> DataFrame:
    """(doc_id, piece, start, length): each document as spans of at most
    ``max_length`` words."""
    rows = docs.select(F.col(id_col).alias("doc_id"), word_count(text_col).alias("words"))
    last = F.greatest(F.floor((F.col("words") - 1) / max_length), F.lit(0)).cast("int")
    return (rows.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
            .withColumn("start", F.col("piece").cast("long") * max_length)
            .withColumn("length", F.least(F.col("words") - F.col("start"), F.lit(max_length)).cast("int")).drop("words"))


def pack_layout(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH,
                buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, seed: int = SEED) -> DataFrame:
    """One row per span: doc_id, piece, start, length, bucket_length, batch, slot."""
    if max_length > token_budget:
        raise ValueError("a batch must hold at least one span of max_length")
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    spans = scratch.save(pieces(docs, id_col, text_col, max_length).withColumn(
        "row", F.monotonically_increasing_id()), "spans")
    seen = spans.where("length > 0").groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = sorted((r["length"], r["n"]) for r in seen)  # at most max_length rows
    bounds = bucket_bounds([a for a, _ in histogram], [n for _, n in histogram], buckets)
    held = {b: 0 for b in bounds}
    of = {}
    for length, n in histogram:
        of[length] = next(b for b in bounds if length <= b)
        held[of[length]] += n
    per_slice = max(256, -(-sum(held.values()) // 65_536))
    known = spark.createDataFrame(
        [(a, b, token_budget // b, -(-held[b] // per_slice)) for a, b in of.items()] or [(-1, 1, 1, 1)],
        "length int, bucket_length int, slots int, slices long")
    rows = (spans.where("length > 0").join(F.broadcast(known), "length")
            .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "piece"))
            .withColumn("slice", F.shiftright(F.shiftrightunsigned("h", 33) * F.col("slices"), 31)))
    order = W.partitionBy("bucket_length").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = (rows.groupBy("bucket_length", "slice").agg(F.count(F.lit(1)).alias("n"))
              .select("bucket_length", "slice", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("slice_at")))
    nth = F.row_number().over(W.partitionBy("bucket_length", "slice").orderBy("h", "doc_id", "piece", "row"))
    at = F.col("slice_at") + F.col("nth") - 1
    placed = (rows.withColumn("nth", nth).join(before, ["bucket_length", "slice"])
              .withColumn("batch", F.floor(at / F.col("slots")).cast("long"))
              .withColumn("slot", (at % F.col("slots")).cast("int")))
    columns = ["doc_id", "piece", "start", "length", "bucket_length", "batch", "slot"]
    none = spans.where("length = 0").withColumns({
        "bucket_length": F.lit(None).cast("int"), "batch": F.lit(None).cast("long"), "slot": F.lit(None).cast("int")})
    return placed.select(*columns).unionByName(none.select(*columns))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_layout(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op2_packing": op2_packing}
