"""Operator 12 against comparing every anchor with every row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as h
from quarry.llm.cover_tree import CoverTree


def brute(rows, is_anchor):
    """rows (id, vector, label) -> (anchor, positive, rank, negative, positive score, negative score)."""
    used = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, q, label) in enumerate(used):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), i is None, i or 0, lab, i)
                         for b, (i, v, lab) in enumerate(used) if b != a and len(v) == len(q)), key=lambda s: s[:3])
        for p, _, _, _, positive in [s for s in scored if s[3] == label][:5]:
            fits = [s for s in scored if s[3] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(anchor, positive, n + 1, s[4], -p, -s[0]) for n, s in enumerate(fits)]
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def clustered(n, dim, seed, groups=12):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, dim))
    x = centres[draw.integers(0, groups, n)] + draw.normal(size=(n, dim)) * draw.choice([0.05, 0.4, 1.0], (n, 1))
    return x * draw.choice([0.2, 1.0, 3.0], (n, 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_search_is_exact(seed):
    x = np.floor(64 * clustered(700, 9, seed)).astype(np.int64)
    x[100:260] = x[100]  # more equal vectors than a leaf holds
    labels = np.arange(700) % 5
    at, ids = np.arange(701), np.arange(700)[::-1].copy()
    tree = CoverTree.from_bytes(CoverTree.build(x, labels, at, ids, ids, np.zeros(700, bool)).to_bytes())
    asked = np.arange(0, 700, 23)
    products = x[asked] @ x.T
    windows = [[(-10**9, 10**9), (int(p.max()) // 3, int(p.max()) * 2 // 3), (0, 0)][:1 + i % 3] for i, p in enumerate(products)]
    for same in (True, False):
        got = tree.search(x[asked], labels[asked], same, [[w[0] for w in own] for own in windows],
                          [[w[1] for w in own] for own in windows], [[-10**9] * len(own) for own in windows], 4)
        for q, scores, own, each in zip(asked, products, windows, got):
            assert len(own) == len(each)
            for (lo, hi), found in zip(own, each):
                fits = ((labels == labels[q]) == same) & (scores >= lo) & (scores <= hi)
                want = sorted((-int(scores[i]), False, int(ids[i]), int(ids[i])) for i in np.flatnonzero(fits))[:4]
                assert found == want


def test_tree_covers_and_separates():
    x = np.floor(64 * clustered(500, 6, 3)).astype(np.int64)
    at = np.arange(501)
    tree = CoverTree.build(x, np.zeros(500, np.int64), at, at[:-1], at[:-1], np.zeros(500, bool))
    for node in range(len(tree.centres)):
        own = tree.points[tree.lo[node]:tree.hi[node]]
        centre = tree.points[tree.centres[node]]
        assert np.linalg.norm(own - centre, axis=1).max() <= tree.radii[node] + 1e-9
        if tree.size[node]:
            children = np.arange(tree.first[node], tree.first[node] + tree.size[node])
            assert tree.lo[children[0]] == tree.lo[node] and tree.hi[children[-1]] == tree.hi[node]
            nets = tree.points[tree.centres[children]]
            apart = np.linalg.norm(nets[:, None] - nets[None], axis=2)[np.triu_indices(len(nets), 1)]
            assert apart.min() >= tree.radii[children].max() - 1e-9


def test_against_brute_force_over_many_blocks(spark):
    x = clustered(900, 8, 4)
    x[200:330] = x[200]  # a hot vector under several labels
    rows = [(i, [float(v) for v in x[i]], i % 4) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    want = key(brute(rows, lambda i: i % 9 == 0))
    got = h.hard_negatives(df, F.col("id") % 9 == 0, F.col("label"), block_rows=40, cells=7, sample=200)
    assert key(got.collect()) == want
    assert key(h.hard_negatives(df, F.col("id") % 9 == 0, F.col("label")).collect()) == want


def test_odd_rows(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-1.0, 0.5, 0.9, 1.0]) for _ in range(3)], i % 2) for i in range(60)]
    rows += [(i, [draw.random() for _ in range(2)], i % 3) for i in range(60, 90)]  # another dimension
    rows += [(None, [1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 0.9], 1), (100, None, 1), (105, [1.0, None, 1.0], 1),
             (110, [1.0, float("nan"), 0.0], 1), (115, [float("inf"), 0.0, 0.0], 0), (120, [1.0, 1.0, 1.0], None),
             (125, [0.0, 0.0, 0.0], 0), (130, [], 0), (135, [], 1), (5, [1.0, 1.0, 1.0], 1), (5, [1.0, 1.0, 1.0], 1),
             (10, rows[10][1], 0), (140, [-1.0, -1.0, -1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {x: F.lit(1) for x in ("id", "row", "vec", "q", "x", "v", "dim", "block", "cell", "score", "w", "tree")})
    got = h.hard_negatives(df, F.col("id") % 5 == 0, F.col("label"))
    assert key(got.collect()) == key(brute(rows, lambda i: i % 5 == 0))
    assert h.hard_negatives(df.limit(0), F.col("id") % 5 == 0, F.col("label")).collect() == []
    assert h.hard_negatives(df, F.lit(False), F.col("label")).collect() == []


def test_percentages_of_large_scores(spark):
    scores = [0, 1, 99, 100, 101, -1, -99, -101, 2**62, -(2**62), 12_345_678_901_234_567]
    df = spark.createDataFrame([(s,) for s in scores], "score long")
    for s, low, high in df.select("score", h.share("score", 50, True), h.share("score", 95, False)).collect():
        assert (low, high) == (-(-50 * s // 100), 95 * s // 100)
