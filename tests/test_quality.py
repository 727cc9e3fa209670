import pytest

from quarry.operators.quality import (ValidationError, anomaly_counts, anomaly_filter,
                                      collapse_top_categories, validate_frame)

RULES = {"lat": (41.5, 42.1), "lon": (-88.0, -87.4), "district": (1, 31)}


def test_anomaly_bounds(spark):
    rows = [(41.5, -88.0, 1), (42.1, -87.4, 31), (41.49, -88.0, 1), (None, -88.0, 1), (42.0, -87.5, 32),
            (40.0, -80.0, 0)]   # last row has two faults
    df = spark.createDataFrame(rows, "lat double, lon double, district int")
    assert anomaly_filter(df, RULES).count() == 2
    r = anomaly_counts(df, RULES, coordinate_cols=("lat", "lon")).first()
    assert (r.invalid_coordinates, r.invalid_district, r.raw_sum, r.rows_with_any_fault) == (2, 2, 4, 3)


def test_validation(spark):
    from pyspark.sql import types as T
    import datetime as dt
    schema = "d timestamp_ntz, district int"
    ok = spark.createDataFrame([(dt.datetime(2020, 1, 1), 31)], schema)
    assert validate_frame(ok, "d", ["district"], ["d"], {"district": (1, 31)}).count() > 0
    with pytest.raises(ValidationError):
        validate_frame(spark.createDataFrame([], schema), "d", ["district"], ["d"], {"district": (1, 31)})
    with pytest.raises(ValidationError):
        validate_frame(ok, "d", ["missing"], ["d"], {})
    with pytest.raises(ValidationError):
        validate_frame(spark.createDataFrame([("x", 1)], "d string, district int"), "d", [], [], {})
    for bad in (0, 32):
        with pytest.raises(ValidationError):
            validate_frame(spark.createDataFrame([(dt.datetime(2020, 1, 1), bad)], schema), "d", [], ["d"],
                           {"district": (1, 31)})


def test_collapse(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] + [(None,)] * 4, "c string")
    got = sorted((r.c, r.n) for r in collapse_top_categories(df, "c", 2, out="n").collect() if r.c is not None)
    assert ("a", "a") in got and ("c", "OTHER") in got and ("b", "OTHER") in got
