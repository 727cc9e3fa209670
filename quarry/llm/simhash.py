"""Operator 13: SimHash near duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has 64 bits: a bit is one if it is set in more than half
of the XXH64 hashes (seed 42) of the text's word shingles, repeats included.
Two fingerprints link at ``radius`` or fewer differing bits.

1. One pass over the texts writes a row per document; equal fingerprints are one
   node from there on, combined before they are shuffled.
2. Every node emits all fingerprints within half the radius of its own. Two
   nodes that link meet at such a variant: one that is half the differing bits
   away from each. A variant has as many nodes at most as a ball of half the
   radius has points (65 for radius 2), however many documents there are.
3. Nodes that meet are within the radius of each other, so in each variant's group
   every node is paired with the smallest one only; pairs are deduplicated, their
   distance is verified, and connected components complete the classes. A link that is
   not emitted joins two nodes that are both linked with the smallest.

Defined results: A-Z is lower-cased; a text with fewer words than a shingle is one
shingle; null, empty and blank texts have fingerprint zero and link like any
other; a very long text is hashed whole, in slices; null ids are ignored when the
smallest id of a component is taken, and a component of null ids only has a null
id; repeated rows have equal fingerprints; an empty table gives an empty result;
only the id and text columns are read, so extra columns never clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm.arrow import tidy, utf8_slices
from quarry.llm.common import LOWER, UPPER, Scratch, table
from quarry.llm.components import components

WIDTH = 3
RADIUS = 2
BITS = 64
SEED = 42
SLICE = 1 << 15  # shingles hashed at a time

_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint of one UTF-8 text as a signed 64-bit integer."""
    words = text.translate(_TO_LOWER).split()  # bytes split at space and TAB..CR
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(width, len(words))
    starts = np.append(0, ends[:len(words) - k] + 1).tolist()
    ends = ends[k - 1:].tolist()
    set_in = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), SLICE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + SLICE], ends[i:i + SLICE])], dtype="<u8")
        set_in += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    most = np.packbits(2 * set_in > len(starts), bitorder="little")
    return int(most.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of each row."""

    def scan(batches):
        for batch in batches:
            found = [fingerprint(b"" if t is None else t.tobytes(), width) for t in utf8_slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(tidy(scan), "doc_id long, fp long")


def ball(fp: Column, reach: int) -> Column:
    """All fingerprints within ``reach`` bits of ``fp``, as an array."""
    masks = [sum(1 << b for b in bits) for n in range(reach + 1) for bits in combinations(range(BITS), n)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: fp.bitwiseXOR(m))


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified pairs (u, v) of the distinct fingerprints ``fp``, enough to
    connect all that are within ``radius`` bits of each other."""
    if radius % 2:
        raise ValueError("the radius has two halves, so it must be even")
    met = (nodes.select("fp", F.explode(ball(F.col("fp"), radius // 2)).alias("variant"))
           .withColumn("least", F.min("fp").over(W.partitionBy("variant"))).where("fp <> least"))
    return (met.select(F.col("least").alias("u"), F.col("fp").alias("v")).distinct()
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       radius: int = RADIUS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 lowercase hex digits),
    component_id. Eager: jobs run while the result is built."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "nodes")
    found = scratch.save(links(nodes, radius), "links")
    labelled = nodes
    if not found.isEmpty():
        labels = components(found, scratch, "fp").withColumnRenamed("node", "fp")
        joined = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
        labelled = joined.join(joined.groupBy("label").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("nodes")), "label").select(
            "fp", F.col("first").alias("least"), F.greatest("copies", "nodes").alias("copies"))
    # a fingerprint that stands alone needs no look-up: its component is the row itself
    shared = scratch.save(labelled.where("copies > 1").select("fp", "least"), "shared")
    return rows.join(shared, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("least", "doc_id").alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op13_simhash": op13_simhash}
