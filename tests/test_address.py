from quarry.functions.address import with_block_features

# FIXTURES §3: block parsing quirks
CASES = [
    ("001XX N STATE ST", 1, "N", "ST", "STATE"),
    ("083XX S DR MARTIN LUTHER KING JR DR", 83, "S", "DR", "DR MARTIN LUTHER KING JR"),
    ("0000X S STATE ST", 0, "S", "ST", "0000X STATE"),
    ("XX W OAK", None, "W", "UNKNOWN", "XX OAK"),
    ("foo st", None, "UNKNOWN", "UNKNOWN", "foo st"),
    ("", None, "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    (None, None, None, None, "UNKNOWN"),
]


def test_block_features(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, block string")
    rows = {r.id: r for r in with_block_features(df, "block").collect()}
    for i, (_, num, d, t, name) in enumerate(CASES):
        r = rows[i]
        assert (r.block_number, r.direction, r.street_type, r.street_name) == (num, d, t, name), CASES[i]
