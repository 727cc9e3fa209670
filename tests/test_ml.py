import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.ml import correlation_long, famd, famd_design, pca, variance_thresholds


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    x[:, 1] = x[:, 0] * 2 + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    var, load, scores = pca(df, ["a", "b", "c", "d"], 3)
    got = [r.explained_ratio for r in var.orderBy("pc").collect()]
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    ev = np.sort(np.linalg.eigvalsh(np.cov(z, rowvar=False)))[::-1]
    assert got == pytest.approx(list(ev[:3] / ev.sum()), rel=1e-6)
    assert scores.count() == 400


def numpy_famd(rows, numeric, categorical, top_n):
    """FAMD by numpy: eigenvalues, contributions and row coordinates up to sign."""
    blocks, owner = [], []
    for c in numeric:
        x = np.array([np.nan if r[c] is None else r[c] for r in rows], dtype=float)
        x = np.where(np.isnan(x), np.nanmedian(x), x)
        blocks.append((x - x.mean()) / (x.std() or 1.0))
        owner.append(c)
    for c in categorical:
        values = ["Unknown" if r[c] is None else r[c] for r in rows]
        top = sorted(set(values), key=lambda v: (-values.count(v), v))[:top_n]
        values = [v if v in top else "OTHER" for v in values]
        for v in sorted(set(values)):
            i = np.array([x == v for x in values], dtype=float)
            blocks.append((i - i.mean()) / np.sqrt(i.mean()))
            owner.append(c)
    z = np.array(blocks).T
    u, s, vt = np.linalg.svd(z / np.sqrt(len(z)), full_matrices=False)
    contribution = {c: (vt ** 2)[:, [o == c for o in owner]].sum(axis=1) for c in set(owner)}
    return s ** 2, contribution, z @ vt.T


@pytest.mark.parametrize("n,constant", [(200, False), (60, True), (4, False)])
def test_famd_matches_numpy(spark, n, constant):
    rows = [{"id": i, "a": None if i % 9 == 5 else float(i * i % 23), "b": 5.0 if constant else float((i * 3) % 11),
             "c": ["x", "y", "z", None, "x", "y", "x"][i % 7], "d": "rare" if i == 1 else "common"} for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c string, d string")
    var, contrib, coords = famd(df, ["a", "b"], ["c", "d"], 6, top_n=2, keep=["id"])
    inertia, contribution, points = numpy_famd(rows, ["a", "b"], ["c", "d"], 2)
    k = min(4, n - 1)  # input columns, and rows less one
    got = [r.explained_ratio for r in var.orderBy("component").collect()]
    assert len(got) == k and got == pytest.approx(list(inertia[:k] / inertia.sum()), abs=1e-9)
    by = {(r.component, r.variable): r for r in contrib.collect()}
    row = {r.id: r for r in coords.collect()}
    for j in range(k):
        if inertia[j] > 1e-9 and all(abs(inertia[j] - x) > 1e-6 for m, x in enumerate(inertia) if m != j):
            for c in "abcd":
                assert by[f"FAMD{j + 1}", c].contribution == pytest.approx(contribution[c][j], abs=1e-7)
                assert by[f"FAMD{j + 1}", c].coordinate == pytest.approx(contribution[c][j] * inertia[j], abs=1e-7)
            mine = np.array([row[i][f"Dim{j + 1}"] for i in range(n)])
            assert min(abs(mine - points[:, j]).max(), abs(mine + points[:, j]).max()) < 1e-6


def test_exact_median_and_thresholds(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (10.0, "x"), (20.0, "y"), (None, "x")], "a double, c string")
    assert famd_design(df, ["a"], ["c"])["numeric"]["a"][0] == 6.0
    variance = spark.createDataFrame([("FAMD1", 0.5, 0.5), ("FAMD2", 0.35, 0.85)],
                                     "component string, explained_ratio double, cumulative_ratio double")
    got = {r.threshold: r.components_needed for r in variance_thresholds(variance).collect()}
    assert got == {0.7: 2, 0.8: 2, 0.9: None, 0.95: None}


def test_pca_loadings_and_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 3)) * [1, 5, 0.2]
    x[:, 2] += x[:, 0]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    _, load, scores = pca(df, ["a", "b", "c"], 2, keep=["id"])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    w = np.linalg.eigh(np.cov(z, rowvar=False))[1][:, ::-1]
    got = {(r.pc, r.feature): r.weight for r in load.collect()}
    points = {r.id: r for r in scores.collect()}
    for j in range(2):
        mine = np.array([got[f"PC{j + 1}", f] for f in "abc"])
        sign = np.sign(mine @ w[:, j])
        assert mine == pytest.approx(sign * w[:, j], abs=1e-6)
        assert [points[i][f"PC{j + 1}"] for i in range(80)] == pytest.approx(list(z @ w[:, j] * sign), abs=1e-6)


def test_correlation_symmetric(spark):
    df = spark.range(0, 100).select(F.col("id").cast("double").alias("a"), (F.col("id") * -3.0).alias("b"),
                                    (F.col("id") % 7).cast("double").alias("c"))
    m = {(r.col_a, r.col_b): r.r for r in correlation_long(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] == -1.0 and m[("a", "a")] == 1.0 and m[("a", "c")] == m[("c", "a")]


def test_one_gram_aggregate_of_many_columns(spark):
    from quarry.operators.gram import gram
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 100)) * rng.uniform(0.01, 50, 100) + rng.uniform(-9, 9, 100)
    x[:, 3] += 1e7      # far from zero: the scan is repeated about the mean
    x[:, 50] = 4.25     # constant
    x[:, 99] = x[:, 0] * -2
    names = [f"c{i}" for i in range(100)]
    rows = [tuple(map(float, r)) for r in x] + [(None, *[1.0] * 99)]
    g = gram(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(6), names)
    assert g.rows == 700 and g.mean == pytest.approx(x.mean(0), rel=1e-9)
    assert g.std[50] == 0 and np.isnan(g.correlation[50, 0])
    assert g.covariance == pytest.approx(np.cov(x, rowvar=False), rel=1e-9, abs=1e-9)
    live = [i for i in range(100) if i != 50]
    assert g.correlation[np.ix_(live, live)] == pytest.approx(np.corrcoef(x[:, live], rowvar=False), abs=1e-9)
    assert gram(spark.createDataFrame(rows[:0], ", ".join(f"{n} double" for n in names)), names).rows == 0


def test_gram_reads_the_table_once(spark):
    from quarry.operators.gram import _about
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gram", "gram")
    _about(df.select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"], np.zeros(2))
    jobs = tracker.getJobIdsForGroup("gram")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert len(jobs) == 1


def test_spectrum_and_projections(spark):
    from quarry.operators.ml import pca_spectrum, projected_variance, standard_scale
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    x[:, 1] += x[:, 0]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(1.0, None, 2.0)], "a double, b double, c double")
    r = np.corrcoef(x, rowvar=False)
    got = {row.power: row.total for row in pca_spectrum(df, ["a", "b", "c"]).collect()}
    assert [got[p] for p in (1, 2, 3, 4)] == pytest.approx([np.trace(np.linalg.matrix_power(r, p)) for p in (1, 2, 3, 4)], abs=1e-9)
    w = np.array([0.5, -0.5, 2.0])
    one = projected_variance(df, ["a", "b", "c"], {"w": list(w)}).first()
    assert one.variance == pytest.approx(w @ r @ w, abs=1e-9) and one.inertia_share == pytest.approx(one.variance / 3)
    z = np.array([tuple(row) for row in standard_scale(df, ["a", "b", "c"], []).collect()])
    assert np.sort(z, axis=0) == pytest.approx(np.sort((x - x.mean(0)) / x.std(0, ddof=1), axis=0), abs=1e-9)
