"""Connected components of an edge list, by contraction.

Each round every node takes its smallest neighbour as parent if that is
smaller than itself, pointer jumping flattens the resulting trees, and the
edges are mapped to the roots. Edges shrink every round; every table is
written to the shared folder, and minima are combined before the shuffle, so a
node with very many edges needs no special care.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v): label is the smallest
    node of its component."""
    pairs = scratch.save(_ordered(edges), f"{name}-edges-0")
    labels, k = None, 0
    while True:
        k += 1
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = scratch.save(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
                               .select("node", F.least("node", "least").alias("parent")), f"{name}-parents-{k}")
        parents = _flattened(parents, scratch, f"{name}-{k}")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            up = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(up, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
        labels = scratch.save(labels, f"{name}-labels-{k}")
        u = parents.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        v = parents.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        mapped = pairs.join(u, "u").join(v, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v"))
        pairs = scratch.save(_ordered(mapped), f"{name}-edges-{k}")
        if pairs.isEmpty():
            return labels


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def _flattened(parents: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Pointer jumping until every parent is a root."""
    k = 0
    while True:
        k += 1
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = scratch.save(parents.join(up, "parent").select(
            "node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")), f"{name}-jump-{k}")
        flat = jumped.where("moved").isEmpty()
        parents = jumped.select("node", "parent")
        if flat:
            return parents
