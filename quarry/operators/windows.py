"""Window operators.

Two regimes:

* windows over **aggregated** rows (per-group top-1, moving averages over
  months, running sums over years) use plain ``Window`` specs;
  per-group top-n becomes Catalyst's ``WindowGroupLimit`` (partial top-n
  before the shuffle);
* global ranks ("top k by rank") never put all groups in one partition:
  the k best values are found with a distributed ``orderBy().limit()``
  (per-partition top-k, then merge) and only those are ranked;
* windows over the **fact** partitioned by a low-cardinality key (row number
  of an incident inside its District, running totals, lag) use
  ``sequence_within_groups``: offsets counted from the keys, or a range-partitioned
  prefix sum; both split every group over many tasks, so a District holding a third
  of the rows is not one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.joins import MAX_BROADCAST_ROWS, bounded_broadcast
from quarry.operators.materialize import materialize


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int = 1,
                  kind: str = "row_number", out: str | None = "rank") -> DataFrame:
    """Top ``n`` rows per group: ``row_number`` (exactly n, add a tie-break
    to ``order``), ``rank`` / ``dense_rank`` (ties kept)."""
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[kind]
    w = Window.partitionBy(*keys).orderBy(*order)
    tmp = out or "__rank"
    res = df.withColumn(tmp, fn().over(w)).filter(F.col(tmp) <= n)
    return res if out else res.drop(tmp)


def topk(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k (``TakeOrderedAndProject``: per-partition top-k + merge)."""
    return df.orderBy(*order).limit(k)


def rank_prefix(df: DataFrame, value: str, k: int, kind: str, tiebreak: list[str],
                descending: bool = True, out: str = "rank", limit_rows: int | None = None) -> DataFrame:
    """Rows with global ``rank``/``dense_rank`` <= k over ``value``, with the rank.

    Exact without a window over the rows: the k best entries of the order (rows
    for ``rank``, distinct values for ``dense_rank``) are found by a distributed
    top-k; a window numbers those k entries, which gives every value its rank, and
    the at most k ranked values are joined to the rows. NULL values have no rank.
    ``limit_rows`` additionally cuts the result, ordered by (rank, tiebreak)."""
    v = F.col(value)
    order_v = v.desc() if descending else v.asc()
    known = df.where(v.isNotNull()).select(value)
    if kind == "rank":
        first = known.orderBy(order_v).limit(k)
        fn = F.rank
    elif kind == "dense_rank":
        first = known.distinct().orderBy(order_v).limit(k)
        fn = F.dense_rank
    else:
        raise ValueError(kind)
    # a window over at most k rows
    ranks = first.withColumn(out, fn().over(Window.orderBy(order_v)).cast("int")).distinct()
    ranked = df.join(bounded_broadcast(ranks, k), value)
    ranked = ranked.select(*df.columns, out)
    if limit_rows is not None:
        ranked = ranked.orderBy(F.col(out), *[F.col(t) for t in tiebreak]).limit(limit_rows)
    return ranked


def dense_rank_all(df: DataFrame, value: str, descending: bool = True, out: str = "rank") -> DataFrame:
    """``dense_rank`` of every row by ``value`` over the whole table (NULLs last when
    descending, first when ascending), without a window over it.

    The distinct values are range-partitioned, sorted and written with their position
    in their range; ranges are counted, and the counts of the ranges before (one number
    per partition, summed on the driver) turn positions into ranks. The planner joins the
    ranked values to the rows by their size. Eager."""
    spark = df.sparkSession
    order = F.col(value).desc() if descending else F.col(value).asc()
    values = df.select(value).distinct().repartitionByRange(order).sortWithinPartitions(order)
    at = F.monotonically_increasing_id()
    ranged = materialize(values.select(value, F.shiftright(at, 33).alias("__range"), (at.bitwiseAND((1 << 33) - 1)).alias("__at")),
                         "ranked-values")
    counts = sorted((r["__range"], r["n"]) for r in ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for number, n in counts:
        starts.append((number, before))
        before += n
    starts = spark.createDataFrame(starts, "__range long, __before long")
    ranks = (ranged.join(bounded_broadcast(starts, len(counts)), "__range")   # a row per partition
             .select(F.col(value).alias("__value"), (F.col("__before") + F.col("__at") + 1).cast("int").alias(out)))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__value"))).select(*df.columns, out)


def moving_average(df: DataFrame, order_col: str, value: str, rows: int = 3,
                   out: str = "moving_avg") -> DataFrame:
    """Mean over the current and ``rows - 1`` preceding rows (a row frame:
    a missing month is skipped, not zero-filled). Global order: use on
    aggregated series only (one row per month)."""
    w = Window.orderBy(order_col).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))


def cumulative_sum(df: DataFrame, order_col: str, value: str, out: str = "cumulative",
                   partition: list[str] | None = None) -> DataFrame:
    """Running sum ``unbounded preceding .. current row`` over aggregated rows."""
    w = (Window.partitionBy(*partition) if partition else Window).orderBy(order_col) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def share_of_partition(df: DataFrame, keys: list[str], value: str, out: str = "share",
                       total: str = "total") -> DataFrame:
    """``value / sum(value) over (partition by keys)``."""
    return (df.withColumn(total, F.sum(value).over(Window.partitionBy(*keys)))
              .withColumn(out, F.col(value) / F.col(total)))


SLICE_ROWS_LOG2 = 20   # rows of one slice at most: 2 ** SLICE_ROWS_LOG2
RUN_ROWS_LOG2 = 24     # rows of one run at most, else the frame is numbered by range


def _runs(df: DataFrame, group_cols: list[str], order_cols: list[str], lag_cols: list[str], partitions: int) -> DataFrame:
    """(group, first order column, __n, __before, last values, last values of the run before), written:
    the rows of equal group and first order column are a run. Read from keys only."""
    first, rest = order_cols[0], order_cols[1:]
    last = F.struct(*rest) if rest else F.lit(0)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.max_by(F.struct(F.col(c)), last).alias(f"__last_{c}") for c in lag_cols if c != first]
    counts = df.groupBy(*group_cols, first).agg(*aggs)
    counts = counts.withColumns({f"__last_{c}": F.struct(F.col(c)) for c in lag_cols if c == first})
    w = Window.partitionBy(*group_cols).orderBy(first)
    out = counts.withColumn("__before", F.sum("__n").over(w) - F.col("__n"))
    for c in lag_cols:
        out = out.withColumn(f"__prev_{c}", F.lag(f"__last_{c}").over(w)[c])
    # where ``repartition`` puts the run
    out = out.withColumn("__part", F.pmod(F.hash(*group_cols, first), F.lit(partitions)))
    return materialize(out.drop(*[f"__last_{c}" for c in lag_cols]), "runs")


def _numbered_by_runs(df: DataFrame, runs: DataFrame, group_cols: list[str], order_cols: list[str], out: str,
                      lag_cols: list[str], partitions: int, bound: int) -> DataFrame:
    """Rows shuffled and sorted once; a row's place in its partition less the rows of the
    runs that stand before its own there is its place in the run."""
    first = order_cols[0]
    keys = [*group_cols, first]
    at = Window.partitionBy("__part").orderBy(*keys)
    starts = runs.withColumn("__start", F.sum("__n").over(at) - F.col("__n"))
    starts = starts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__before", "__start", *[f"__prev_{c}" for c in lag_cols])
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = df.repartition(partitions, *keys).sortWithinPartitions(*keys, *order_cols[1:]).withColumn("__pos", place)
    for c in lag_cols:  # the rows lie and are sorted as this window asks
        rows = rows.withColumn(f"__lag_{c}", F.lag(c).over(Window.partitionBy(*keys).orderBy(*order_cols[1:])))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    joined = rows.join(bounded_broadcast(starts, bound), same)
    nth = F.col("__pos") - F.col("__start")
    joined = joined.withColumns({out: (nth + F.col("__before") + 1).cast("long"), **{
        f"lag_{c}": F.when(nth == 0, F.col(f"__prev_{c}")).otherwise(F.col(f"__lag_{c}")) for c in lag_cols}})
    return joined.select(*df.columns, out, *[f"lag_{c}" for c in lag_cols])


def sequence_within_groups(df: DataFrame, group_cols: list[str], order_cols: list[str],
                           out: str = "row_num", num_partitions: int | None = None,
                           lag_cols: list[str] | None = None,
                           slice_rows_log2: int = SLICE_ROWS_LOG2, run_rows_log2: int = RUN_ROWS_LOG2) -> DataFrame:
    """``row_number() over (partition by group order by order_cols)`` (and
    optionally ``lag(c)`` for ``lag_cols``) computed without putting a group in
    one task. NULL groups are groups; ``df`` may have any further columns. Eager.

    ``order_cols`` must make the order total (end with a unique key).

    If rows of equal group and first order column (runs) are few enough to be broadcast and
    none is too large, they are counted from the keys alone, and the counts of the runs
    before it are a run's offset: rows are shuffled and sorted once, and nothing but the
    counts is written. Else the order itself is cut:

    1. The rows are range-partitioned by (group, order), sorted, numbered
       (``monotonically_increasing_id``: task in the high bits, row in the low
       ones) and written once, so everything below reads the same numbers.
       Blocks of ``2 ** slice_rows_log2`` rows of a task are slices; their size
       does not depend on the number of partitions.
    2. A small table per (slice, group): first position, row count, last
       values. A window over that table gives the rows of the same group in
       earlier slices. It is joined back NULL-safe; the planner picks the join.
    3. row_number = position - first position in slice + earlier rows + 1.
       ``lag`` inside a slice is the previous row; at a slice start it is the
       last row of the group in the previous slice."""
    lag_cols = lag_cols or []
    partitions = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = _runs(df, group_cols, order_cols, lag_cols, partitions)
    size = runs.agg(F.count(F.lit(1)).alias("runs"), F.max("__n").alias("most")).first()
    if size["runs"] <= MAX_BROADCAST_ROWS and (size["most"] or 0) <= 1 << run_rows_log2:
        return _numbered_by_runs(df, runs, group_cols, order_cols, out, lag_cols, partitions, max(1, size["runs"]))
    keys = [*group_cols, *order_cols]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    sliced = materialize(ranged.sortWithinPartitions(*keys).withColumn("__pos", F.monotonically_increasing_id()), "sliced")
    sliced = sliced.withColumn("__slice", F.shiftright("__pos", slice_rows_log2))
    stat_aggs = [F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__n")]
    stat_aggs += [F.max_by(c, "__pos").alias(f"__last_{c}") for c in lag_cols]
    stats = sliced.groupBy("__slice", *group_cols).agg(*stat_aggs)
    w = Window.partitionBy(*group_cols).orderBy("__slice")
    stats = stats.withColumn("__before", F.sum("__n").over(w) - F.col("__n"))
    for c in lag_cols:
        stats = stats.withColumn(f"__prev_{c}", F.lag(f"__last_{c}").over(w))
    stats = stats.select(F.col("__slice").alias("__s"), *[F.col(g).alias(f"__g_{g}") for g in group_cols],
                         "__first", "__before", *[f"__prev_{c}" for c in lag_cols])
    same = F.col("__slice") == F.col("__s")
    for g in group_cols:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    res = sliced.join(stats, same)
    res = res.withColumn(out, (F.col("__pos") - F.col("__first") + F.col("__before") + 1).cast("long"))
    # a window keyed by (slice, group), so that a hot group is spread over many tasks
    wl = Window.partitionBy("__slice", *group_cols).orderBy("__pos")
    for c in lag_cols:
        res = res.withColumn(f"lag_{c}", F.when(F.col("__pos") == F.col("__first"), F.col(f"__prev_{c}"))
                             .otherwise(F.lag(c).over(wl)))
    return res.select(*df.columns, out, *[f"lag_{c}" for c in lag_cols])
