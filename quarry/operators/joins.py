"""Join helpers: bounded broadcast, scalar attach, lookups, semi joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.materialize import ROW, SLICE, broadcast_limit, buckets_of, materialize, planned_bytes

# Largest frame that may be broadcast because its size is bounded by construction.
MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, bound: int) -> DataFrame:
    """Broadcast a frame whose size is bounded by construction (a top-k with
    ``k = bound``, a one-row aggregate, a fixed lookup). ``bound`` documents
    the proof; it is checked to be small."""
    if bound > MAX_BROADCAST_ROWS:
        raise ValueError(f"bound {bound} too large to broadcast")
    return F.broadcast(df)


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df`` as a
    scalar subquery: it runs once, in the plan (no collect, no join), and a frame
    of more than one row is an error at run time. No row gives NULLs."""
    value = one_row.select(F.struct(*one_row.columns).alias("__scalar")).scalar()
    out = df.withColumn("__scalar", value)
    return out.select(*df.columns, *[F.col(f"__scalar.`{c}`").alias(c) for c in one_row.columns])


def lookup_join(df: DataFrame, lookup: DataFrame, keys: list[str], out: list[str],
                needed: Column | None = None) -> DataFrame:
    """Left join of a lookup with unique keys; NULL keys never match, and rows
    that do not need the lookup (``needed`` false) get NULL.

    The lookup should be a written table (``settled``), so that its size is known:

    * up to the planner's broadcast threshold it is broadcast by its file size, and
      ``df`` streams past it;
    * beyond it, if ``df`` is a numbered table (``materialize.numbered``), the keys and
      numbers of the rows that need a value are joined with the lookup, and what they found
      is shuffled to the table's buckets: no other column of ``df`` moves (the session then
      plans with ``spark.sql.requireAllClusterKeysForCoPartition`` off);
    * else ``df`` is shuffled by the keys, and rows with a NULL key or without need, which
      would all meet in one task, carry a spreading number that no lookup row has."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if needed is not None:
        whole = whole & F.coalesce(needed, F.lit(False))
    right = lookup.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *out)
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__r_{k}") for k in keys])
    if planned_bytes(right) <= broadcast_limit(df.sparkSession):
        if needed is not None:
            cond = cond & F.coalesce(needed, F.lit(False))
        return df.join(right, cond, "left").select(*df.columns, *out)
    buckets = buckets_of(df)
    if buckets:
        # the table lies by slice, a part of the join's keys: without this the planner would shuffle it all the same
        df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        asked = df.where(whole).select(F.col(SLICE).alias("__r_slice"), F.col(ROW).alias("__r_row"), *keys)
        found = asked.join(right, cond).select("__r_slice", "__r_row", *out).repartition(buckets, "__r_slice")
        return (df.join(found, (F.col(SLICE) == F.col("__r_slice")) & (F.col(ROW) == F.col("__r_row")), "left")
                .select(*df.columns, *out))
    spread = F.when(whole, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*df.columns), F.lit(1024)))
    left = df.withColumn("__spread", spread.cast("long"))
    right = right.withColumn("__r_spread", F.lit(0).cast("long"))
    return left.join(right, cond & (F.col("__spread") == F.col("__r_spread")), "left").select(*df.columns, *out)


def settled(lookup: DataFrame, label: str = "lookup") -> DataFrame:
    """The lookup, written: it is computed once and the planner knows its size. Eager."""
    return materialize(lookup, label)


def semi_join_top(df: DataFrame, key: str, k: int, count_name: str = "count") -> DataFrame:
    """Keep rows of ``df`` whose ``key`` is among the ``k`` most frequent
    keys (ties broken by key). The top list has at most ``k`` rows, so it is
    broadcast; the fact is not shuffled for the join."""
    top = (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
           .orderBy(F.desc(count_name), F.asc(key)).limit(k).select(key))
    return df.join(bounded_broadcast(top, k), key, "left_semi")
