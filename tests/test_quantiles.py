"""Exact quantiles by radix selection."""

import math
import random
import struct

import numpy as np
import pytest

from quarry.operators.agg import count_quantiles, ordered_image, quantiles
from pyspark.sql import functions as F

AT = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "high": 1.0}


def test_image_keeps_the_order_of_doubles(spark):
    draw = random.Random(1)
    values = [struct.unpack("d", struct.pack("Q", draw.getrandbits(64)))[0] for _ in range(3000)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1023, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan")]
    values += [s * math.nextafter(2.0 ** e, d) for e in range(-1022, 1024, 31) for d in (0, float("inf")) for s in (1, -1)]
    values += [2.0 ** e for e in range(-1074, 1024, 17)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", ordered_image(F.col("x")).alias("i")).collect()
    real = sorted((r for r in rows if not math.isnan(r.x)), key=lambda r: r.x)
    for a, b in zip(real, real[1:]):
        assert (a.i < b.i) == (a.x < b.x) and (a.i == b.i) == (a.x == b.x), (a, b)
    assert all(r.i > real[-1].i for r in rows if math.isnan(r.x))
    for r in rows:  # for positive values it is the bit pattern itself
        if 0 < r.x < float("inf"):
            assert r.i == struct.unpack("q", struct.pack("d", r.x))[0]


@pytest.mark.parametrize("values", [
    [float(i) for i in range(1999)] + [1e300],          # one far outlier
    [1.0] * 500 + [2.0], [-1e-300, 0.0, 1e-300, 5.0], [7.5], [float((i * 37) % 101) - 50 for i in range(700)]])
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(4)
    got = quantiles(df, "x", AT).first()
    for name, q in AT.items():
        assert got[name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-305), name


def test_quantiles_of_nothing(spark):
    row = quantiles(spark.createDataFrame([(None,)], "x double"), "x", AT).collect()
    assert len(row) == 1 and set(row[0]) == {None}


def test_several_columns_and_no_ordered_range(spark):
    """Two hundred thousand values that share one range of a grid, and an outlier: no
    window of the selection sees more than 2^16 rows."""
    n = 200_000
    base = spark.range(n).select(F.lit("a").alias("feature"), (F.col("id") / 1e9).alias("x"), F.lit(1).cast("long").alias("n"))
    counts = base.unionByName(spark.createDataFrame([("a", 1e12, 1), ("b", 1.0, 3), ("b", 2.0, 1)], "feature string, x double, n long"))
    got = {(r.feature, r.name): r.quantile for r in count_quantiles(counts, {"m": 0.5}, 2).collect()}
    assert got["a", "m"] == pytest.approx(n / 2 / 1e9, rel=1e-12) and got["b", "m"] == 1.0
