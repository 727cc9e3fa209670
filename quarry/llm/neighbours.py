"""Operator 9: approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard
transform; a unit vector's hash is the signed axis nearest to the rotated
vector. A table joins ``axes`` such hashes into a cell. Queries probe the
``probes`` cells of each table whose axes have the largest sums of rotated
coordinates, and every vector found is scored exactly, in double precision on
the original vectors.

The number of cells is fixed (tables x (2 * dimension)^axes), so the counts per
cell are collected and plan the work: neighbouring cells share a block of about
``block_rows`` vectors, a cell larger than that is split over several blocks
by a hash of the id. A task holds one block at a time and streams the queries
that probe it, keeping the best ``k`` per query.

Cells hash directions only, so a vector's length does not move it. What a first
search finds tells how far to go on: a vector among a query's best ``k`` has an
inner product of at least the ``k``-th found, so the longer it is, the wider its
angle may be. ``reach`` gives, for each place in a query's order of cells, the
largest cosine of a pair whose cell may still lie there; it is measured on drawn
pairs of the same hash functions, so it follows the number of cells. A second
search takes every further cell whose longest vector could, at that cosine,
reach the ``k``-th found. Where that means as many vectors as there are, or
fewer than ``k`` were found, the query is compared with all cells of one table,
which is exact.

Defined results: vectors that are null, zero, hold null or non-finite
components, or have another than the most frequent dimension take no part, nor
do rows without id; of rows with the same id the smallest vector counts; fewer
than ``k`` candidates are all returned; an empty table gives an empty result;
only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.arrow import tidy
from quarry.llm.common import Scratch, table

TABLES = 8
AXES = 2
PROBES = 1500
K = 20
BLOCK_ROWS = 16_384
SEED = 17
FOUND = 0.98  # of the pairs at a cosine, those whose cell lies within its reach
PAIRS = 400


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to a rotation."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


class CrossPolytope:
    """The hash functions for vectors of one dimension."""

    def __init__(self, dim: int, tables: int = TABLES, axes: int = AXES, seed: int = SEED):
        self.dim, self.tables, self.axes, self.seed = dim, tables, axes, seed
        self.width = 1 << max(1, (dim - 1).bit_length())
        self.cells = (2 * self.width) ** axes
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, axes, 3, self.width))

    def padded(self, x: np.ndarray) -> np.ndarray:
        """Directions of the rows, filled up to the width."""
        out = np.zeros((len(x), self.width))
        # scaled by the largest component first, so that squares do not overflow
        out[:, :self.dim] = x / np.abs(x).max(axis=1, keepdims=True)
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    def rotated(self, x: np.ndarray, table_: int, axis: int) -> np.ndarray:
        for s in self.signs[table_, axis]:
            x = hadamard(x * s)
        return x

    def cell_of(self, x: np.ndarray, table_: int) -> np.ndarray:
        cell = np.zeros(len(x), dtype=np.int64)
        for a in range(self.axes):
            r = self.rotated(x, table_, a)
            at = np.abs(r).argmax(axis=1)
            cell = cell * 2 * self.width + 2 * at + (r[np.arange(len(x)), at] < 0)
        return cell

    def sums(self, x: np.ndarray, table_: int) -> np.ndarray:
        """For each row, the sum of its rotated coordinates on each cell's axes."""
        total = np.zeros((len(x), 1))
        for a in range(self.axes):
            r = self.rotated(x, table_, a)
            signed = np.stack([r, -r], axis=2).reshape(len(x), 2 * self.width)
            total = (total[:, :, None] + signed[:, None, :]).reshape(len(x), -1)
        return total

    def probed(self, x: np.ndarray, table_: int, probes: int) -> np.ndarray:
        """The ``probes`` best cells of each row by sums of coordinates."""
        probes = min(probes, self.cells)
        return np.argpartition(-self.sums(x, table_), probes - 1, axis=1)[:, :probes]

    def reach(self, found: float = FOUND, pairs: int = PAIRS) -> np.ndarray:
        """For each place in the order of cells, the largest cosine at which
        more than ``1 - found`` of the pairs have their cell there or later in
        every table; -1 if there is none. Falls with the place."""
        levels = np.linspace(-1, 1, 81)
        rng = np.random.default_rng(self.seed)
        q, u = self.padded(rng.normal(size=(pairs, self.dim))), self.padded(rng.normal(size=(pairs, self.dim)))
        u -= (u * q).sum(axis=1, keepdims=True) * q
        u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
        best = np.full((pairs, len(levels)), self.cells)
        rows = np.arange(pairs)
        for t in range(self.tables):
            own, parts = np.zeros((pairs, len(levels))), []
            for a in range(self.axes):
                rq, ru = self.rotated(q, t, a), self.rotated(u, t, a)
                parts.append(np.concatenate([rq, -rq], axis=1))
                for i, c in enumerate(levels):
                    r = c * rq + np.sqrt(1 - c * c) * ru  # rotations are linear
                    at = np.abs(r).argmax(axis=1)
                    own[:, i] += np.where(r[rows, at] < 0, -1, 1) * rq[rows, at]
            for p in range(pairs):
                first = np.zeros(1)
                for part in parts[:-1]:
                    first = (first[:, None] + part[p][None, :]).reshape(-1)
                last = np.sort(parts[-1][p])
                above = len(last) - np.searchsorted(last, own[p][:, None] + 1e-9 - first[None, :], "right")
                best[p] = np.minimum(best[p], above.sum(axis=1))
        places = np.quantile(best, found, axis=0, method="higher")
        places = np.maximum.accumulate(places[::-1])[::-1]  # a wider angle never needs fewer cells
        out = np.full(self.cells, -1.0)
        for c, place in zip([*levels[1:], 1.0], places):  # cosines up to the next level count as this one
            out[:int(place) + 1] = np.maximum(out[:int(place) + 1], c)
        return out


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def usable_vectors(rows: DataFrame, scratch: Scratch, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector as double array, norm) of the rows that take part; their dimension."""
    v = F.col("vector")
    real = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & (F.size(v) > 0) & real & F.exists(v, lambda x: x != 0)))
    dims = good.groupBy(F.size(v).alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    dim = dims["dim"] if dims else 1
    scale = F.array_max(F.transform(v, lambda x: F.abs(x)))
    norm = scale * F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale)))
    kept = scratch.save(good.where(F.size(v) == dim).groupBy("id").agg(F.min("vector").alias("vector"))
                        .withColumn("norm", norm), "vectors")
    return kept, dim


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    values = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).reshape(-1, dim)


def plan_blocks(counts: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of each (table, cell); cells of a
    table share blocks in order until one is full, large cells have their own."""
    first, number = np.zeros(counts.shape, dtype=np.int64), np.ones(counts.shape, dtype=np.int64)
    block = 0
    for t in range(len(counts)):
        small = np.where(counts[t] > block_rows, 0, counts[t])
        first[t] = block + (np.cumsum(small) - small) // block_rows
        block = int(first[t].max()) + 1
        for cell in np.flatnonzero(counts[t] > block_rows):
            number[t, cell] = -(-int(counts[t, cell]) // block_rows)
            first[t, cell] = block
            block += int(number[t, cell])
    return first, number, block


def further_cells(h: CrossPolytope, unit: np.ndarray, floors: np.ndarray, counts: np.ndarray, longest: np.ndarray,
                  reach: np.ndarray, probes: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each table (query positions, cells) that the first search left out
    and that may hold one of a query's best: ``floors`` has each query's
    ``k``-th score by its own length, nan if fewer were found."""
    out, work = [], np.zeros(len(unit), dtype=np.int64)
    for t in range(h.tables):
        at, cells, known = [], [], np.flatnonzero(counts[t])
        total = h.sums(unit, t)
        for i in np.flatnonzero(~np.isnan(floors)):
            place = h.cells - np.searchsorted(np.sort(total[i]), total[i, known], "right")
            more = known[(place >= probes) & ~(reach[place] * longest[t, known] < floors[i])]
            at.append(np.full(len(more), i))
            cells.append(more)
            work[i] += counts[t, more].sum()
        out.append((np.concatenate(at), np.concatenate(cells)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    everything = np.isnan(floors) | (work >= counts[0].sum())  # one table has every vector once
    out = [(q[~everything[q]], cell[~everything[q]]) for q, cell in out]
    known, these = np.flatnonzero(counts[0]), np.flatnonzero(everything)
    q, cell = out[0]
    out[0] = np.append(q, np.repeat(these, len(known))), np.append(cell, np.tile(known, len(these)))
    return out


def _search(vectors: DataFrame, queries: DataFrame, hasher: CrossPolytope, counts: np.ndarray, probes: int, k: int,
            block_rows: int, longest: np.ndarray | None = None, reach: np.ndarray | None = None) -> DataFrame:
    """(query_id, vec_ids, scores): the best ``k`` per query and block, from the
    ``probes`` best cells or, given ``reach``, from the further cells."""
    spark, tables = vectors.sparkSession, hasher.tables
    first, number, blocks = plan_blocks(counts, block_rows)
    # a few numbers per cell, a fixed number of cells
    shared = spark.sparkContext.broadcast((hasher, first, number, counts, longest, reach))
    schema = "block long, side int, id long, vector array<double>, cells array<int>"
    arrow = pa.schema([("block", pa.int64()), ("side", pa.int32()), ("id", pa.int64()),
                       ("vector", pa.list_(pa.float64())), ("cells", pa.list_(pa.int32()))])

    def as_rows(block, side, ids, at, matrix, cells):
        flat = pa.array(matrix[at].reshape(-1))
        starts = pa.array(np.arange(len(at) + 1, dtype=np.int32) * matrix.shape[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(block, pa.int64()), pa.array(np.full(len(at), side, np.int32)), pa.array(ids[at]),
             pa.ListArray.from_arrays(starts, flat), cells], schema=arrow)

    def place_vectors(batches):
        h, first, number = shared.value[:3]
        for batch in batches:
            ids, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1), h.dim)
            unit = h.padded(matrix)
            for t in range(tables):
                cell = h.cell_of(unit, t)
                block = first[t, cell] + (ids * 2654435761 % 2**31) % number[t, cell]
                ones = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32)),
                                                pa.array(cell.astype(np.int32)))
                yield as_rows(block, 0, ids, np.arange(len(ids)), matrix, ones)

    def place_queries(batches):
        h, first, number, counts, longest, reach = shared.value
        step = max(1, min(128, 2**21 // h.cells))
        for batch in batches:
            all_ids, all_rows = batch.column(0).to_numpy(), _matrix(batch.column(1), h.dim)
            for lo in range(0, len(all_ids), step):
                ids, matrix = all_ids[lo:lo + step], all_rows[lo:lo + step]
                unit = h.padded(matrix)
                if reach is not None:
                    floors = batch.column(2).to_numpy(zero_copy_only=False)[lo:lo + step]
                    more = further_cells(h, unit, floors, counts, longest, reach, probes)
                for t in range(tables):
                    if reach is not None:
                        q, cell = more[t]
                    else:
                        cells = h.probed(unit, t, probes)
                        q, cell = np.repeat(np.arange(len(ids)), cells.shape[1]), cells.reshape(-1)
                        some = counts[t][cell] > 0
                        q, cell = q[some], cell[some]
                    times = number[t, cell]
                    block = np.repeat(first[t, cell], times) + (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
                    q, cell = np.repeat(q, times), np.repeat(cell, times)
                    if not len(q):
                        continue
                    order = np.lexsort((cell, block, q))
                    q, cell, block = q[order], cell[order], block[order]
                    cut = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (block[1:] != block[:-1])]))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(cut, len(q)).astype(np.int32)),
                                                     pa.array(cell.astype(np.int32)))
                    yield as_rows(block[cut], 1, ids, q[cut], matrix, lists)

    dim = hasher.dim

    def score(batches):
        """Rows come ordered by block, vectors before queries."""
        here, ids, cells, rows = None, [], [], []
        ready = None
        for batch in batches:
            block, side = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (side[1:] != side[:-1])]))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(block)]):
                part = batch.slice(a, b - a)
                matrix = _matrix(part.column("vector"), dim)
                if block[a] != here:
                    here, ids, cells, rows, ready = block[a], [], [], [], None
                if side[a] == 0:
                    ids.append(part.column("id").to_numpy())
                    cells.append(part.column("cells").flatten().to_numpy())
                    rows.append(matrix)
                    continue
                if not ids:
                    continue
                if ready is None:
                    order = np.argsort(np.concatenate(cells), kind="stable")
                    ready = (np.concatenate(cells)[order], np.concatenate(ids)[order], np.concatenate(rows)[order])
                known, vec_ids, vecs = ready
                query_ids, lists = part.column("id").to_numpy(), part.column("cells")
                found = []
                for i in range(len(query_ids)):
                    want = lists[i].values.to_numpy()
                    lo, hi = np.searchsorted(known, want, "left"), np.searchsorted(known, want, "right")
                    n = hi - lo
                    at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    at = at[vec_ids[at] != query_ids[i]]
                    if not len(at):
                        continue
                    got, own = vec_ids[at], np.einsum("ij,j->i", vecs[at], matrix[i])
                    top = best_of(own, got, k)
                    found.append((query_ids[i], got[top], own[top]))
                if found:
                    yield _lists(found)

    rows = vectors.mapInArrow(tidy(place_vectors), schema).unionByName(queries.mapInArrow(tidy(place_queries), schema))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks // 4))
    return (rows.repartition(n, "block").sortWithinPartitions("block", "side")
            .mapInArrow(tidy(score), _FOUND))


def nearest(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            tables: int = TABLES, axes: int = AXES, probes: int = PROBES, block_rows: int = BLOCK_ROWS,
            seed: int = SEED) -> DataFrame:
    """For each row for which ``is_query`` (a condition on column ``id``)
    holds: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "neighbours")
    kept, dim = usable_vectors(rows, scratch, id_col, vector_col)
    vectors = kept.select("id", "vector")
    hasher = CrossPolytope(dim, tables, axes, seed)
    shared = spark.sparkContext.broadcast(hasher)

    def count(batches):
        h = shared.value
        sums, most = np.zeros((h.tables, h.cells), dtype=np.int64), np.zeros((h.tables, h.cells))
        for batch in batches:
            unit, norm = h.padded(_matrix(batch.column(1), h.dim)), batch.column(2).to_numpy()
            for t in range(h.tables):
                cell = h.cell_of(unit, t)
                sums[t] += np.bincount(cell, minlength=h.cells)
                np.maximum.at(most[t], cell, norm)
        t, cell = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(sums[t, cell]),
                                          pa.array(most[t, cell])], names=["t", "cell", "n", "most"])

    counts, longest = np.zeros((tables, hasher.cells), dtype=np.int64), np.zeros((tables, hasher.cells))
    found = (kept.select("id", "vector", "norm").mapInArrow(tidy(count), "t int, cell int, n long, most double")
             .groupBy("t", "cell").agg(F.sum("n").alias("n"), F.max("most").alias("most"))
             .groupBy("t").agg(F.collect_list(F.struct("cell", "n", "most")).alias("all")).collect())
    for r in found:  # a fixed number of cells per table
        for c in r["all"]:
            counts[r["t"], c["cell"]], longest[r["t"], c["cell"]] = c["n"], c["most"]
    queries = kept.where(is_query)
    merged = scratch.save(_top(_search(vectors, queries.select("id", "vector"), hasher, counts, probes, k, block_rows), k), "found")
    want = min(k, int(counts[0].sum()) - 1)
    if want <= 0 or probes >= hasher.cells:
        return merged
    # the k-th score found by the query's own length: what a vector's length times the cosine must reach
    last = merged.where(F.col("rank") == want).select(F.col("query_id").alias("id"), F.col("score").alias("last"))
    reach = hasher.reach()
    floors = queries.join(last, "id", "left").select(
        "id", "vector", F.coalesce(F.col("last") / F.col("norm"), F.lit(float("nan"))).alias("floor"))
    more = scratch.save(floors.where(F.isnan("floor") | (F.col("floor") <= float(reach[probes] * longest.max()))), "more")
    if more.isEmpty():
        return merged
    again = _search(vectors, more, hasher, counts, probes, k, block_rows, longest, reach)
    lists = merged.groupBy("query_id").agg(F.collect_list("vec_id").alias("vec_ids"), F.collect_list("score").alias("scores"))
    return _top(lists.unionByName(again), k)


_FOUND = "query_id long, vec_ids array<long>, scores array<double>"


def _lists(found: list[tuple]) -> pa.RecordBatch:
    starts = pa.array(np.cumsum([0] + [len(f[1]) for f in found]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int64()),
         pa.ListArray.from_arrays(starts, pa.array(np.concatenate([f[1] for f in found]))),
         pa.ListArray.from_arrays(starts, pa.array(np.concatenate([f[2] for f in found])))],
        names=["query_id", "vec_ids", "scores"])


def _top(found: DataFrame, k: int) -> DataFrame:
    """Merge the blocks' lists, a query at a time: rows come ordered by query."""

    def merged(query, ids, scores):
        ids, first = np.unique(np.concatenate(ids), return_index=True)
        scores = np.concatenate(scores)[first]
        top = best_of(scores, ids, k)
        return np.full(len(top), query), np.arange(1, len(top) + 1, dtype=np.int32), ids[top], scores[top]

    def merge(batches):
        query, ids, scores = None, [], []
        for batch in batches:
            out = []
            for q, i, s in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if q != query:
                    if ids:
                        out.append(merged(query, ids, scores))
                    query, ids, scores = q, [], []
                ids.append(i.values.to_numpy())
                scores.append(s.values.to_numpy())
            if out:
                yield _ranked(out)
        if ids:
            yield _ranked([merged(query, ids, scores)])

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (found.repartition(n, "query_id").sortWithinPartitions("query_id")
            .mapInArrow(tidy(merge), "query_id long, rank int, vec_id long, score double"))


def _ranked(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                      names=["query_id", "rank", "vec_id", "score"])


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


QUERIES = {"op9_neighbours": op9_neighbours}
