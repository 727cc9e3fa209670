import pytest
from pyspark.sql import functions as F

from quarry.operators.agg import group_mode
from quarry.operators.impute import (impute_dominant_mode, impute_from_parent, impute_mean_hierarchy,
                                     impute_mode, sentinel_fill)


def test_mode_hierarchy(spark):
    rows = [
        # (id, name, type, dir, district, number)
        (1, "A", "ST", "N", 1, 10), (2, "A", "ST", "N", 1, 20), (3, "A", "ST", "N", 1, None),   # tie -> 10
        (4, "B", "ST", "N", 1, None), (5, "B", "ST", "S", 2, 7), (6, "B", "ST", "S", 2, None),  # level 3 for 4
        (7, "A", "ST", "N", None, None),                                                         # NULL district -> level 2
        (8, "C", "AVE", "E", 3, None),                                                           # no match anywhere
    ]
    df = spark.createDataFrame(rows, "id int, street_name string, street_type string, direction string, "
                                     "district int, block_number int")
    levels = [["street_name", "street_type", "direction", "district"],
              ["street_name", "street_type", "direction"], ["street_name", "street_type"]]
    got = {r.id: r.block_number for r in impute_mode(df, "block_number", levels).collect()}
    assert got == {1: 10, 2: 20, 3: 10, 4: 7, 5: 7, 6: 7, 7: 10, 8: None}


def test_dominant_mode_threshold(spark):
    rows = []
    # group g79: 79 of 100 -> not dominant; g80: 80 of 100 -> dominant; g100: all
    for g, top in (("g79", 79), ("g80", 80), ("g100", 100)):
        rows += [(g, "X") for _ in range(top)] + [(g, "Y") for _ in range(100 - top)] + [(g, None)]
    rows.append((None, None))
    df = spark.createDataFrame(rows, "g string, loc string")
    out = impute_dominant_mode(df, "loc", ["g"], 0.8)
    filled = {r.g: r.loc for r in out.filter(F.col("loc").isin("X", "Unknown")).groupBy("g", "loc").count()
              .filter("count = 1 or loc = 'Unknown'").collect()}
    res = {(r.g, r.loc) for r in out.join(df.filter(F.col("loc").isNull()).select("g").distinct(), "g", "inner")
           .collect()}
    nulls = out.filter(F.col("loc").isNull()).count()
    assert nulls == 0
    mode = {r.g: r.loc_mode for r in group_mode(df, ["g"], "loc", min_share=0.8).collect()}
    assert mode == {"g80": "X", "g100": "X"}
    assert out.count() == df.count()


def test_parent_and_sentinel(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 0), (1, None), (2, None)], "beat int, district int")
    out = impute_from_parent(df, "district", "beat")
    assert sorted((r.beat, r.district) for r in out.collect()) == sorted(
        [(1, 5), (1, 5), (1, 5), (1, 5), (2, None)])
    s = sentinel_fill(out, ["district"])
    assert sorted(r.district for r in s.collect()) == [-1, 5, 5, 5, 5]


def test_mean_hierarchy(spark):
    rows = [  # id, area, ward, lat, lon
        (1, 1, 1, 10.0, 20.0), (2, 1, 1, 12.0, 22.0), (3, 1, 1, None, None),   # area mean
        (4, 0, 2, 30.0, 40.0), (5, 0, 2, None, 41.0),                          # area 0 -> ward mean
        (6, None, None, None, 1.0),                                            # global mean for lat
    ]
    df = spark.createDataFrame(rows, "id int, area int, ward int, lat double, lon double")
    got = {r.id: (r.lat, r.lon) for r in impute_mean_hierarchy(df, ["lat", "lon"], ["area", "ward"]).collect()}
    assert got[3] == (11.0, 21.0)
    assert got[5] == (30.0, 41.0)
    assert got[6][0] == pytest.approx((10 + 12 + 30) / 3) and got[6][1] == 1.0
