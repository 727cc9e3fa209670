"""Operator 12: hard-negative mining with cover trees.

An anchor's positives are the rows of its label with the largest inner products;
for each positive, the hard negatives are the rows of other labels with the
largest inner products inside a window given by the positive's score.

1. Vectors become integers, ``floor(scale * x)``. Rows with equal vector and label
   are one candidate with its smallest ids: no row beyond the first
   ``positives + 1`` by id can be among an anchor's first. They are cut where they
   are read, so a vector however frequent is a few rows afterwards. Equal anchors
   are one query.
2. The top of the cover tree is a farthest-first net over norm-augmented candidates,
   chosen on a sample of at most ``SAMPLE`` of them; every candidate goes to the cell of
   its nearest centre, whose covering radius is taken over all. Large cells are split
   into blocks by a hash, and each block gets a cover tree (``cover_tree``),
   written once.
3. A search goes best first through cells: a query first visits a block of the
   cell with the largest bound; what it finds there sets the floor below
   which other blocks are skipped. Inside a block the descent is best first as
   well, skips nodes whose bounds lie outside all windows, and verifies leaves
   exactly. One search finds positives, a second one negatives.

Anchors are a stated set of queries; each visits the blocks that its bounds leave.

Defined results: rows with a null label, a null vector, or any null or non-finite
component take no part, nor do vectors whose integer form is longer than 2^31,
whose inner products need not fit in a long; vectors are compared with those of the
same dimension only (dimensions are searched one after another); a zero or an empty
vector has inner product 0 with every other; null ids come last in ties and are
no anchors unless the condition says so; repeated rows count as rows of their own;
fewer than the asked rows are all returned; an empty table gives an empty result;
extra columns are not read and never clash. Scores are exact. Eager: jobs run
while the result is built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm.arrow import tidy
from quarry.llm.common import Scratch, table
from quarry.llm.cover_tree import CoverTree, angle, augmented, inner_bounds, net

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
SAMPLE = 4096
CELLS = 512
BLOCK_ROWS = 4096
QUERIES_AT_ONCE = 256
LONGEST = 2.0 ** 31
LEAST, MOST = -(1 << 62) - 1, (1 << 62) + 1  # beyond any score

_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_QUERY = "q long, label long, vec array<long>, lows array<long>, highs array<long>, floors array<long>"
_FOUND = "q long, w int, score long, no_id boolean, id long, row long"


def candidate_rows(rows: DataFrame, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, row, label, vec, dim) of the rows that take part; ``row`` tells repeated rows apart."""
    x = F.col("x")
    real = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    given = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("x"))
    whole = (given.where(F.col("label").isNotNull() & x.isNotNull() & real)
             .withColumn("v", F.transform(x, lambda v: F.floor(v * scale).cast("double"))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, v: s + v * v))
    return whole.where(length <= LONGEST).select(
        "id", F.monotonically_increasing_id().alias("row"), "label", F.col("v").cast("array<long>").alias("vec"),
        F.size("v").alias("dim"))


def distinct_candidates(rows: DataFrame, keep: int) -> DataFrame:
    """(label, vec, dim, ids): each vector and label once, with its first ``keep`` rows by id."""
    first = W.partitionBy("vec", "label").orderBy(F.col("id").asc_nulls_last(), "row")
    kept = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= keep)
    return kept.groupBy("vec", "label", "dim").agg(
        F.sort_array(F.collect_list(F.struct(F.isnull("id").alias("no_id"), "id", "row"))).alias("ids"))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of equal length; empty ones count as one zero."""
    n = len(column)
    if not dim:
        return np.zeros((n, 1), dtype=np.int64)
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy().reshape(n, dim)


class Cells:
    """The top of the tree: centres, covering radii, and the blocks of each cell."""

    def __init__(self, centres: np.ndarray, most: float):
        self.centres, self.most = centres, most
        self.angles = np.zeros(len(centres))
        self.first = self.pieces = np.zeros(len(centres), dtype=np.int64)

    def hold(self, cells: np.ndarray, radii: np.ndarray, counts: np.ndarray, block_rows: int) -> None:
        """Keep the cells that hold vectors and number their blocks."""
        self.centres, self.angles = self.centres[cells], angle(radii, self.most)
        self.pieces = -(-counts // block_rows)
        self.first = np.cumsum(self.pieces) - self.pieces

    def bounds(self, queries: np.ndarray):
        real = queries.astype(np.float64)
        return inner_bounds(real, np.sqrt((real * real).sum(axis=1)), self.centres[:, :-1], self.angles, self.most)


def plant(nodes: DataFrame, dim: int, scratch: Scratch, block_rows: int, cells: int, sample: int) -> tuple[DataFrame, Cells]:
    """(block, tree): every candidate of ``nodes`` in one tree; and the cells."""
    spark = nodes.sparkSession
    square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    stats = nodes.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("most")).first()
    drawn = nodes.select("vec", F.xxhash64("vec", "label").alias("h")).orderBy("h", "vec").limit(sample).collect()
    drawn = np.array([r["vec"] for r in drawn], dtype=np.int64).reshape(len(drawn), dim) if dim else np.zeros((1, 1), np.int64)
    points = augmented(drawn, stats["most"])
    top = Cells(points[net(points, max(1, min(cells, -(-stats["n"] // block_rows))), 0.0)[0]], stats["most"])
    shared = spark.sparkContext.broadcast(top)  # at most ``cells`` vectors

    def assign(batches):
        c = shared.value
        square = (c.centres ** 2).sum(axis=1)
        for batch in batches:
            p = augmented(_matrix(batch.column("vec"), dim), c.most)
            near = (square - 2 * p @ c.centres.T).argmin(axis=1)
            away = np.sqrt(((p - c.centres[near]) ** 2).sum(axis=1))
            yield batch.append_column("cell", pa.array(near.astype(np.int32))).append_column("away", pa.array(away))

    placed = scratch.save(nodes.select("label", "vec", "ids").mapInArrow(
        tidy(assign), "label long, vec array<long>, ids array<struct<no_id:boolean,id:long,row:long>>, cell int, away double"),
        f"placed-{dim}")
    held = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
    number = np.array([r["cell"] for r in held])
    top.hold(number, np.array([r["radius"] for r in held]), np.array([r["n"] for r in held]), block_rows)
    blocks = spark.createDataFrame(
        [(int(c), int(f), int(p)) for c, f, p in zip(number, top.first, top.pieces)], "cell int, first long, pieces long")
    # one row for each of at most ``cells`` cells
    dealt = placed.join(F.broadcast(blocks), "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("vec", "label"), "pieces")).alias("block"), "label", "vec", "ids")

    def grow(batches):
        here, held = None, []

        def tree():
            t = pa.Table.from_batches(held)
            ids = t.column("ids").combine_chunks()
            each = ids.flatten()
            built = CoverTree.build(
                _matrix(t.column("vec"), dim), t.column("label").to_numpy(),
                np.append(0, np.cumsum(ids.value_lengths().to_numpy())), each.field("id").fill_null(0).to_numpy(),
                each.field("row").to_numpy(), each.field("no_id").to_numpy(zero_copy_only=False))
            return pa.RecordBatch.from_arrays([pa.array([here], pa.int64()), pa.array([built.to_bytes()], pa.binary())],
                                              names=["block", "tree"])

        for batch in batches:
            block = batch.column("block").to_numpy()
            cut = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else []
            for a, b in zip(cut, np.append(cut[1:], len(block)) if len(block) else []):
                if block[a] != here:
                    if held:
                        yield tree()
                    here, held = int(block[a]), []
                held.append(batch.slice(a, b - a))
        if held:
            yield tree()

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(top.pieces.sum()) // 4))
    grown = dealt.repartition(n, "block").sortWithinPartitions("block").mapInArrow(tidy(grow), "block long, tree binary")
    return scratch.save(grown, f"trees-{dim}"), top


def visit(trees: DataFrame, queries: DataFrame, top: Cells, dim: int, same: bool, k: int, first: bool) -> DataFrame:
    """What the queries find in the block with the largest bound (``first``), or in
    all other blocks that their bounds leave."""
    spark = trees.sparkSession
    shared = spark.sparkContext.broadcast(top)
    columns = "block long, side int, tree binary, " + _QUERY
    longs = pa.list_(pa.int64())
    arrow = pa.schema([("block", pa.int64()), ("side", pa.int32()), ("tree", pa.binary()), ("q", pa.int64()),
                       ("label", pa.int64()), ("vec", longs), ("lows", longs), ("highs", longs), ("floors", longs)])

    def place(batches):
        c = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            least, largest = c.bounds(_matrix(batch.column("vec"), dim))
            home = largest.argmax(axis=1)
            own = c.first[home] + batch.column("q").to_numpy() % c.pieces[home]
            if first:
                at, blocks = np.arange(batch.num_rows), own
            else:
                goes = np.zeros(least.shape, dtype=bool)
                for i, (lows, highs, floors) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("lows", "highs", "floors")))):
                    for lo, hi, floor in zip(lows, highs, floors):
                        goes[i] |= (max(lo, floor) <= largest[i]) & (hi >= least[i])
                at, cell = np.nonzero(goes)
                many = c.pieces[cell]
                at, cell = np.repeat(at, many), np.repeat(cell, many)
                blocks = c.first[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(many) - many, many)
                other = blocks != own[at]
                at, blocks = at[other], blocks[other]
            for i in range(0, len(at), 1024):  # queries are copied for each block that they visit
                some = pa.array(at[i:i + 1024])
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[i:i + n], pa.int64()), pa.array(np.ones(n, dtype=np.int32)), pa.nulls(n, pa.binary()),
                     *[batch.column(x).take(some) for x in ("q", "label", "vec", "lows", "highs", "floors")]], schema=arrow)

    def search(batches):
        """Rows come ordered by block, the tree before the queries."""
        tree, here = None, None
        for batch in batches:
            block, side = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            cut = np.flatnonzero((block[1:] != block[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
                if a == b:
                    continue
                if side[a] == 0:
                    tree, here = CoverTree.from_bytes(batch.column("tree")[a].as_py()), block[a]
                    continue
                if block[a] != here:
                    raise RuntimeError(f"no tree for block {block[a]}")
                for i in range(a, b, QUERIES_AT_ONCE):
                    yield answers(tree, batch.slice(i, min(QUERIES_AT_ONCE, b - i)))

    def answers(tree, asked):
        q, lows, highs, floors = (asked.column(n).to_pylist() for n in ("q", "lows", "highs", "floors"))
        found = tree.search(_matrix(asked.column("vec"), dim), asked.column("label").to_numpy(), same, lows, highs, floors, k)
        rows = [(q[i], w, -s, no_id, None if no_id else id_, at)
                for i, own in enumerate(found) for w, best in enumerate(own) for s, no_id, id_, at in best]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)],
                                          names=["q", "w", "score", "no_id", "id", "row"])

    names = [f.name for f in arrow]
    sent = queries.repartition("q").mapInArrow(tidy(place), columns)
    blank = {n: F.lit(None).cast(t) for n, t in (("q", "long"), ("label", "long"), ("vec", "array<long>"),
                                                 ("lows", "array<long>"), ("highs", "array<long>"), ("floors", "array<long>"))}
    rows = trees.withColumns({"side": F.lit(0), **blank}).select(names).unionByName(sent)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(top.pieces.sum()) // 4))
    return rows.repartition(n, "block").sortWithinPartitions("block", "side").mapInArrow(tidy(search), _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query and window."""
    order = W.partitionBy("q", "w").orderBy(F.desc("score"), "no_id", "id", "row")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def search(trees: DataFrame, queries: DataFrame, top: Cells, dim: int, same: bool, k: int, scratch: Scratch, name: str) -> DataFrame:
    """The first ``k`` of each query (columns of ``_QUERY`` but the floors) and window."""
    open_ = queries.withColumn("floors", F.col("lows"))
    home = scratch.save(_first(visit(trees, open_, top, dim, same, k, True), k), f"{name}-home")
    reached = home.where(F.col("nth") == k).groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("reached"))
    floors = F.transform("lows", lambda low, w: F.coalesce(F.try_element_at("reached", w.cast("int")), low))
    rest = scratch.save(open_.join(reached, "q", "left").withColumn("floors", floors).drop("reached"), f"{name}-rest")
    found = home.drop("nth").unionByName(visit(trees, rest, top, dim, same, k, False))
    return scratch.save(_first(found, k), name)


def share(score: str, percent: int, up: bool) -> Column:
    """``percent`` of an integer score, rounded up or down, without overflow."""
    rest = F.expr(f"pmod(`{score}`, 100)")
    hundreds = F.expr(f"(`{score}` - pmod(`{score}`, 100)) div 100")
    part = (rest * percent + (99 if up else 0)) / 100
    return hundreds * percent + F.floor(part).cast("long")


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = SCALE, block_rows: int = BLOCK_ROWS, cells: int = CELLS, sample: int = SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score;
    ``is_anchor`` is a condition on column ``id``."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    used = scratch.save(candidate_rows(rows, label, id_col, vector_col, scale), "rows")
    keep = max(positives + 1, negatives)
    nodes = scratch.save(distinct_candidates(used, keep), "nodes")
    asked = used.where(is_anchor)
    queries = scratch.save(asked.groupBy("vec", "label", "dim").agg(F.count(F.lit(1)).alias("anchors"))
                           .withColumn("q", F.monotonically_increasing_id()), "queries")
    anchors = scratch.save(asked.join(queries.drop("anchors"), ["vec", "label", "dim"])
                           .select("q", F.col("id").alias("anchor_id"), F.col("row").alias("anchor_row")), "anchors")
    dims = [r["dim"] for r in queries.select("dim").distinct().orderBy("dim").collect()]
    out = spark.createDataFrame([], _RESULT)
    for dim in dims:
        own = queries.where(F.col("dim") == dim).select("q", "label", "vec")
        trees, top = plant(nodes.where(F.col("dim") == dim), dim, scratch, block_rows, cells, sample)
        everything = own.withColumns({"lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(MOST))})
        near = search(trees, everything, top, dim, True, positives + 1, scratch, f"positives-{dim}")
        # the windows of a query: one for each score that a positive may have
        windows = (near.select("q", "score").distinct()
                   .withColumns({"low": share("score", low, True), "high": share("score", high, False)})
                   .where("low <= high").groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "low", "high"))).alias("ws")))
        windows = scratch.save(own.join(windows, "q").select(
            "q", "label", "vec", F.col("ws.low").alias("lows"), F.col("ws.high").alias("highs"), F.col("ws.score").alias("scores")),
            f"windows-{dim}")
        hard = search(trees, windows.drop("scores"), top, dim, False, negatives, scratch, f"negatives-{dim}")
        of_score = windows.select("q", F.posexplode("scores").alias("w", "positive_score"))
        hard = hard.join(of_score, ["q", "w"]).select("q", "positive_score", F.col("nth").alias("rank"), F.col("id").alias("negative_id"),
                                                      F.col("score").alias("negative_score"))
        order = W.partitionBy("q", "anchor_row").orderBy(F.desc("score"), "no_id", "id", "row")
        first = (anchors.join(near.drop("nth", "w"), "q").where("row <> anchor_row")
                 .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
                 .select("q", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
        found = first.join(hard, ["q", "positive_score"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
        out = out.unionByName(found)
    return out


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("id") % 50 == 0, label)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE = {"op12_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""}
