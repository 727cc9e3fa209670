"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

import quarry
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.materialize import scratch_table
from quarry.sources.tables import read_table

# White space is space and TAB..CR, words are runs of the rest.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BITMAP_BITS = 32768  # positions of one bitmap row, fixed by bitmap_bit_position


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per session.

    Spark's own file server distributes the archive, so workers import the
    functions they run wherever they are started."""
    context = spark.sparkContext
    if getattr(context, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(quarry.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quarry-ship-"), "quarry_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    context._quarry_shipped = True


class Scratch:
    """Intermediate tables of one run in the shared checkpoint folder.

    A saved table cuts the lineage and survives lost executors. They go with
    ``quarry.operators.materialize.release`` once the results have been read."""

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark = spark
        self.folder = scratch_table(spark, f"llm-{label}")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.load(name, df.schema)

    def load(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, list(columns) or None)


def word_count(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def one_space(text: Column) -> Column:
    """The text with each run of white space replaced by one space."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def hash_filter(hashes: DataFrame, bits: int = 20) -> DataFrame:
    """A bitmap of ``2**bits`` positions over the 64-bit values of the only
    column of ``hashes``: rows (slot, bitmap) of 4 KB each, so at most
    ``2**bits / 8`` bytes whatever the input size; safe to broadcast."""
    h = F.pmod(F.col(hashes.columns[0]), F.lit(1 << bits))
    return (hashes.select(F.floor(h / _BITMAP_BITS).cast("int").alias("slot"), (h % _BITMAP_BITS).alias("bit"))
            .groupBy("slot").agg(F.expr("bitmap_construct_agg(bit)").alias("bitmap")))


def maybe_in(df: DataFrame, hash_col: str, bitmap: DataFrame, flag: str, bits: int = 20) -> DataFrame:
    """Add boolean ``flag``: false only if the row's hash is not in the
    bitmap. An equi-join on the slot against the size-bounded bitmap rows."""
    small = bitmap.select(F.col("slot").alias("__slot"), F.col("bitmap").alias("__bitmap"))
    at = f"pmod(`{hash_col}`, {1 << bits})"
    byte = f"cast(conv(hex(substring(`__bitmap`, cast(floor({at} % {_BITMAP_BITS} / 8) as int) + 1, 1)), 16, 10) as int)"
    bit = f"(shiftright({byte}, cast({at} % 8 as int)) & 1) = 1"
    return (df.join(F.broadcast(small), F.expr(f"cast(floor({at} / {_BITMAP_BITS}) as int)") == F.col("__slot"), "left")
            .withColumn(flag, F.coalesce(F.expr(bit), F.lit(False)))
            .drop("__slot", "__bitmap"))
