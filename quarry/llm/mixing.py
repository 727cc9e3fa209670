"""Operator 3: mixing sources to target weights with a hypergeometric tree.

1. Word counts per source give the targets: weights share a budget, no source
   is used more than ``max_epochs`` times, and the excess of capped sources is
   shared again by weight (water filling on one row per source).
2. A keyed hash permutes each source's documents. Their running word count
   lays the source out as a line that repeats once per epoch; a source takes
   the documents that lie wholly before its target; then, one at a time, the
   document whose size comes closest to the words still missing is added, or to
   those too many left out. A source that single documents have not closed after
   ``fill_rounds`` goes on in passes over all rows: documents that fit the gap,
   one after another in hash order, then the closest single one, until no
   document brings it nearer. Running counts are taken inside
   hash slices of bounded size plus the slices' prefix sums, so a hot source is
   spread over many tasks.
3. The line is cut into blocks of words; those that hold a copy are counted.
   From these block quotas of the sources a splitting tree draws, by multivariate hypergeometric sampling,
   how many blocks of each source go to the left half of the output shards,
   and so on down to single shards. Each shard then gets disjoint blocks of a
   permutation of the source's blocks and orders its copies by a keyed hash.

Only one row per source and the numbers of the blocks that hold copies (about
5/3 of ``max_blocks`` at most) pass through the driver. Defined results: null text has size 0 and is never taken; a null
source is a source of its own, last in order; repeated rows are separate
documents; a source without words has target 0; an empty table gives an empty
result. Every choice is a function of ids, sources and the seed, so reruns
agree. Only id, source and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, table, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2
FILL_ROUNDS = 6
SEED = 17


def targets(sizes: list[int], weights: list[float], share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Water filling: ``min(cap, level * weight)`` with the level at which the
    targets add up to ``share`` of all sizes."""
    total, left = share * sum(sizes), 0.0
    caps = [float(max_epochs * s) for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i])
    rest = sum(weights)
    level = 0.0
    for i in order:
        level = (total - left) / rest
        if level <= caps[i] / weights[i]:
            break
        left += caps[i]
        rest -= weights[i]
    return [min(c, level * w) for c, w in zip(caps, weights)]


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Exact block quotas per shard, (shards x sources), by a splitting tree:
    each node draws its left half's share from its own quotas."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    nodes = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while nodes:
        lo, hi, have = nodes.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        take = int(have.sum()) * (mid - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(have, take, method="marginals")
        nodes += [(lo, mid, left), (mid, hi, have - left)]
    return out


def deal_blocks(quotas: list[int], shards: int, seed: int = SEED) -> list[tuple[int, int, int]]:
    """(source, block, shard): each shard's quota of every source, filled from
    a permutation of the source's blocks."""
    split = split_quotas(np.asarray(quotas, dtype=np.int64), shards, seed)
    out = []
    for s, n in enumerate(quotas):
        blocks = np.random.default_rng([seed, s]).permutation(n)
        shard = np.repeat(np.arange(shards), split[:, s])
        out += [(s, int(b), int(d)) for b, d in zip(blocks, shard)]
    return out


def document_sizes(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", source_col: str = "source",
                   text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, content, row, h): no text, one row per document."""
    key = F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), F.col(source_col))
    return scratch.save(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        F.xxhash64(F.col(text_col)).alias("content"), F.monotonically_increasing_id().alias("row"),
        F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long").alias("h")), "sizes")


def plan_mix(sizes: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, share: float = SHARE,
             max_epochs: int = MAX_EPOCHS, fill_rounds: int = FILL_ROUNDS) -> tuple[DataFrame, list[dict]]:
    """Rows of ``sizes`` with their source's numbers, their place on the line
    and ``copies``; and one dict per source."""
    spark = sizes.sparkSession
    found = sizes.groupBy("source").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("docs")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    if not found:
        empty = sizes.select("*", F.lit(0).alias("index"), F.lit(0).cast("long").alias("source_size"),
                             F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("start"), F.lit(0).alias("copies"))
        return empty, []
    goal = targets([r["total"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share, max_epochs)
    per_slice = max(256, -(-sum(r["docs"] for r in found) // 65_536))
    plan = []
    for i, (r, t) in enumerate(zip(found, goal)):
        full = min(max_epochs, int(t // r["total"])) if r["total"] else 0
        plan.append({"index": i, "source": r["source"], "source_size": r["total"], "target": float(t), "full": full,
                     "rest": float(t - full * r["total"]), "slices": -(-r["docs"] // per_slice)})
    known = spark.createDataFrame(
        [tuple(p[k] for k in ("index", "source", "source_size", "target", "full", "rest", "slices")) for p in plan],
        "index int, source_name string, source_size long, target double, full int, rest double, slices long")
    rows = sizes.join(F.broadcast(known), sizes.source.eqNullSafe(known.source_name)).drop("source_name")
    placed = scratch.save(_running(rows, F.col("size"), "start").drop("slices"), "placed")
    inside = (F.col("start") + F.col("size") <= F.col("rest")) & (F.col("size") > 0)
    taken = {r["index"]: r["words"] for r in
             placed.where(inside).groupBy("index").agg(F.sum("size").alias("words")).collect()}
    gap = {p["index"]: p["rest"] - taken.get(p["index"], 0) for p in plan}
    # documents added or left out again to close the gaps: at most one per source and round
    turned: list[tuple[int, int]] = []
    chosen = placed.where("size > 0").withColumn("inside", inside)
    near, rounds = _closest(chosen, gap), 0
    while near and rounds < fill_rounds:
        turned += _take(near, gap)
        chosen = _turned(placed.where("size > 0").withColumn("inside", inside), turned)
        near, rounds = _closest(chosen, gap), rounds + 1
    out = _turned(placed.withColumn("inside", inside), turned)
    if near:
        out = _close(out, gap, plan, scratch)
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("full") + F.col("inside").cast("int")).otherwise(0))
    out = out.drop("inside", "full", "rest")
    return out, plan


def _running(rows: DataFrame, words: Column, name: str) -> DataFrame:
    """Add column ``name``: the sum of ``words`` over the source's rows before
    this one in hash order; ``slices`` has the number of the source's slices."""
    rows = rows.withColumn("slice", F.shiftright(F.shiftright("h", 29) * F.col("slices"), 31))
    order = W.partitionBy("index").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = (rows.groupBy("index", "slice").agg(F.sum(words).alias("words"))
              .select("index", "slice", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("slice_at")))
    within = W.partitionBy("index", "slice").orderBy("h", "doc_id", "row").rowsBetween(W.unboundedPreceding, -1)
    return (rows.withColumn("within", F.coalesce(F.sum(words).over(within), F.lit(0))).join(before, ["index", "slice"])
            .withColumn(name, F.col("slice_at") + F.col("within")).drop("within", "slice_at", "slice"))


def _gaps(spark: SparkSession, gap: dict[int, float]) -> DataFrame:
    return spark.createDataFrame([(i, float(g)) for i, g in gap.items() if g] or [(-1, 0.0)], "index int, gap double")


def _closest(rows: DataFrame, gap: dict[int, float]) -> list:
    """For each source, the document that brings it nearest to its target when
    added or left out again, if any does."""
    off = F.abs(F.col("size") - F.abs("gap"))
    return (rows.where("size > 0").join(F.broadcast(_gaps(rows.sparkSession, gap)), "index")
            .where((F.col("inside") == (F.col("gap") < 0)) & (off < F.abs("gap")))
            .groupBy("index").agg(F.min(F.struct(off.alias("off"), "h", "doc_id", "row", "size")).alias("m")).collect())


def _take(near: list, gap: dict[int, float]) -> list[tuple[int, int]]:
    """Count the documents found into ``gap``; their (index, row)."""
    for r in near:
        gap[r["index"]] -= r["m"]["size"] * (1 if gap[r["index"]] > 0 else -1)
    return [(r["index"], r["m"]["row"]) for r in near]


def _close(rows: DataFrame, gap: dict[int, float], plan: list[dict], scratch: Scratch) -> DataFrame:
    """Go on until no document brings a source nearer to its target. A pass
    adds, or leaves out, all documents that fit the gap one after another in
    hash order, then the closest single one."""
    spark = rows.sparkSession
    slices = spark.createDataFrame([(p["index"], p["slices"]) for p in plan], "index int, slices long")
    step = 0
    while near := _closest(rows, gap):
        open_ = {r["index"] for r in near}
        need = _gaps(spark, {i: g for i, g in gap.items() if i in open_})
        fits = (F.col("size") > 0) & (F.col("inside") == (F.col("gap") < 0)) & (F.col("size") <= F.abs("gap"))
        met = rows.join(F.broadcast(need), "index", "left").withColumn("fits", F.coalesce(fits, F.lit(False)))
        met = _running(met.join(F.broadcast(slices), "index"), F.when(F.col("fits"), F.col("size")).otherwise(0), "at")
        turn = F.col("fits") & (F.col("at") + F.col("size") <= F.abs("gap"))
        rows = scratch.save(met.withColumn("turn", F.coalesce(turn, F.lit(False)))
                            .withColumn("inside", F.col("inside") != F.col("turn")).drop("gap", "fits", "at", "slices", "turn"),
                            f"closed{step}")
        taken = {r["index"]: r["words"] for r in rows.where("inside").groupBy("index").agg(F.sum("size").alias("words")).collect()}
        gap.update({p["index"]: p["rest"] - taken.get(p["index"], 0) for p in plan if p["index"] in open_})
        rows = _turned(rows, _take(_closest(rows, gap), gap))
        step += 1
    return rows


def _turned(rows: DataFrame, turned: list[tuple[int, int]]) -> DataFrame:
    """Switch ``inside`` once for each time that a row is listed."""
    times = [(*k, sum(t == k for t in turned)) for k in set(turned)] or [(-1, -1, 0)]
    known = rows.sparkSession.createDataFrame(times, "index int, row long, times int")
    met = rows.join(F.broadcast(known), ["index", "row"], "left")
    return met.withColumn("inside", F.col("inside") != (F.coalesce("times", F.lit(0)) % 2 == 1)).drop("times")


def draw(rows: DataFrame, plan: list[dict], shards: int | None = None, block_words: int = 100_000,
         shard_words: int = 100_000_000, max_blocks: int = 65_536, seed: int = SEED) -> DataFrame:
    """One row per copy: the plan's rows with ``copy``, ``shard`` and ``shard_order``."""
    total = sum(p["target"] for p in plan)
    width = max(block_words, -(-int(total + 1) // max_blocks))
    shards = shards or max(1, round(total / shard_words))
    copies = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    copies = copies.withColumn("block", F.floor(
        ((F.col("copy") - 1) * F.col("source_size") + F.col("start")) / width).cast("long"))
    # only blocks that hold copies are dealt: at most about 5/3 of max_blocks and a few per source
    held: list[list[int]] = [[] for _ in plan]
    for r in copies.select("index", "block").distinct().collect():
        held[r["index"]].append(r["block"])
    held = [sorted(h) for h in held]
    dealt = rows.sparkSession.createDataFrame(
        [(i, held[i][b], d) for i, b, d in deal_blocks([len(h) for h in held], shards, seed)] or [(-1, 0, 0)],
        "index int, block long, shard int")
    return (copies.join(F.broadcast(dealt), ["index", "block"])
            .withColumn("shard_order", F.xxhash64(F.lit(seed), "shard", "h", "row", "copy")).drop("block"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    scratch = Scratch(spark, "mixing")
    rows, plan = plan_mix(document_sizes(docs, scratch), scratch)
    taken = draw(rows, plan).groupBy("row").agg(F.sum("size").alias("taken"), F.count(F.lit(1)).alias("copies"))
    return (rows.drop("copies").join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """The mix itself: the input's columns, a row per copy. Rows that are
    equal in id, source and text share their copies evenly."""
    scratch = Scratch(docs.sparkSession, "mixed")
    rows, plan = plan_mix(document_sizes(docs, scratch, id_col, source_col, text_col), scratch)
    rows = rows.withColumn("equal", F.count(F.lit(1)).over(W.partitionBy("doc_id", "source", "content")))
    drawn = (draw(rows, plan).groupBy("doc_id", "source", "content", "equal").agg(F.count(F.lit(1)).alias("__all"))
             .select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "source", "content", "equal")], "__all"))
    drawn = scratch.save(drawn, "drawn")
    same = [F.col(id_col).eqNullSafe(F.col("__doc_id")), F.col(source_col).eqNullSafe(F.col("__source")),
            F.col("__here") == F.col("__content")]
    keys = W.partitionBy(F.col("__here"), F.col(id_col), F.col(source_col))
    texts = docs.withColumn("__here", F.xxhash64(F.col(text_col)))
    alone = texts.join(drawn.where("__equal = 1"), same).withColumn("__copies", F.col("__all").cast("int"))
    # rows that repeat are numbered among themselves; only their texts are moved again
    nth, n = F.row_number().over(keys.orderBy(F.lit(0))), F.col("__equal")
    each = F.floor(F.col("__all") / n) + F.when(nth <= F.col("__all") % n, 1).otherwise(0)
    repeated = texts.join(drawn.where("__equal > 1"), same).withColumn("__copies", each.cast("int"))
    met = alone.unionByName(repeated).where("__copies > 0")
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


QUERIES = {"op3_mixing": op3_mixing}

_FILL = """
turn{k} AS (
  SELECT i, arg_min(doc_id, (abs(size - abs(gap)), h, doc_id)) AS doc_id, arg_min(size, (abs(size - abs(gap)), h, doc_id)) AS size
  FROM state{j} JOIN gap{j} USING (i) WHERE inside = (gap < 0) AND abs(size - abs(gap)) < abs(gap) GROUP BY i),
gap{k} AS (SELECT i, gap - coalesce(size, 0) * sign(gap) AS gap FROM gap{j} LEFT JOIN turn{k} USING (i)),
state{k} AS (SELECT * REPLACE (inside <> (doc_id IN (SELECT doc_id FROM turn{k})) AS inside) FROM state{j}),"""

ORACLE = {"op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', '17', doc_id::VARCHAR, source)), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS t, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][i % 3 + 1] AS w, 2.0::DOUBLE * t AS cap FROM s),
k AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(t) FROM w) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / w, i)),
v AS (SELECT min(level) FILTER (level <= cap / w) AS level FROM (SELECT * FROM k QUALIFY row_number() OVER (
        PARTITION BY level <= cap / w ORDER BY cap / w, i) = 1)),
g AS (SELECT source, i, t, least(cap, v.level * w) AS target,
             CASE WHEN t > 0 THEN least(2, floor(least(cap, v.level * w) / t)) ELSE 0 END AS whole FROM w, v),
p AS (
  SELECT d.*, g.i, g.t, g.target, g.whole, g.target - g.whole * g.t AS rest,
         coalesce(sum(size) OVER (PARTITION BY g.i ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
state0 AS (SELECT *, start + size <= rest AS inside FROM p WHERE size > 0),
gap0 AS (SELECT i, any_value(rest) - coalesce(sum(size) FILTER (size > 0 AND start + size <= rest), 0) AS gap FROM p GROUP BY i),
""" + "".join(_FILL.format(k=k, j=k - 1) for k in range(1, FILL_ROUNDS + 1)).lstrip() + r"""
f AS (SELECT * FROM state""" + str(FILL_ROUNDS) + r""")
SELECT doc_id, size, t AS source_size, target, (size * copies)::BIGINT AS taken, copies::BIGINT AS copies
FROM (SELECT p.*, coalesce(p.whole + f.inside::INTEGER, 0) AS copies FROM p LEFT JOIN f USING (doc_id))
"""}
