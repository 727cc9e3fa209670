"""Operators 4, 6, 7 and 9."""

import base64
import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import language_id, neighbours, url_filters, warc
from quarry.llm.common import Scratch, table

SF = "/root/testdata/sf0.01"


def test_language_accuracy_on_held_out(spark):
    docs = table(spark, SF, "documents")
    got = language_id.op4_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and len(held) > 200
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    # calibration: the mean score is about the accuracy
    assert abs(np.mean([r.score for r in held]) - np.mean([r.lang_pred == r.lang for r in held])) < 0.05


def test_language_learns_from_labels_outside_the_fold_only(spark):
    docs = table(spark, SF, "documents", "doc_id", "text", "lang")
    wrong = docs.withColumn("lang", F.when(language_id.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    a, b = language_id.fit(docs, per_language=60), language_id.fit(wrong, per_language=60)
    assert a.languages == b.languages and (a.weights == b.weights).all()


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = language_id.fit(odd_docs)
    out = language_id.annotate(odd_docs, model, lang="__lang", score="__score")
    assert out.columns == [*odd_docs.columns, "__lang", "__score"]
    rows = out.select("doc_id", "text", "__lang", "__score").collect()
    for r in rows:
        undefined = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r["__lang"] == "und") == undefined and (r["__score"] == 0) == undefined
    assert language_id.annotate(no_docs, model).collect() == []
    assert language_id.fit(no_docs) is None
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.fit(unlabelled) is None
    assert {r.lang_pred for r in language_id.annotate(odd_docs, None).collect()} == {"und"}


def test_url_filters_of_odd_rows(spark):
    rows = [(1, "http://WWW.Example.COM/en/x?q#f"), (2, "https://a.example.com/en"), (3, "x://a.net/fr/"), (4, None),
            (5, ""), (6, "no scheme"), (7, "://net/es/1"), (8, "http://notexample.com/en/"), (9, "http://com"),
            (None, "http://b.com/"), (1, "http://WWW.Example.COM/en/x?q#f"), (10, "http://net?/es/"),
            (11, "http://" + "a." * 300 + "com/" + "p/" * 2000), (12, "http://a.com/\n/en/"), (13, "http://.com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit(1) for c in ("host", "rule", "row", "prefix", "verdict")})
    rules = [*url_filters.RULES, ("block", "com", "/p"), ("block", "a.com", ""), ("allow", "a.com", "")]
    got = url_filters.judge_urls(df, rules, default="none").collect()

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:end].lower(), rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules
                if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, "none", None))
        return host, path, best[3], best[2]

    assert sorted(got, key=str) == sorted([(i, *judge(u)) for i, u in rows], key=str)
    assert url_filters.judge_urls(df.limit(0), rules).collect() == []


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


EVIL = ("x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9:z:1>\r\nContent-Length: 5\r\n\r\nabcde"
        "\r\n\r\nWARC/1.1\r\nrest\r\n\r\n")
PAGES = [(1, "u", "héé"), (2, "u", None), (3, None, ""), (4, "u", "héé"), (5, "a b", EVIL), (6, "u", EVIL), (None, "u", "héé"),
         (7, "u", "WARC/1.1\r\n"), (8, "u", "WARC/1.1\r\n" * 3), (9, "u", EVIL * 3), (1, "u", "héé"), (10, "u", "\r\n\r\n"),
         (11, "u\r\nX: y", "solo"), (12, "u", "y" * 300_000), (13, "u", "\r\n"), (14, "u", EVIL + "y" * 50_000)]


@pytest.mark.parametrize("least,split", [(0, "134217728"), (0, "997"), (6, "20000")])
def test_archives_round_trip(spark, least, split):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns(
        {c: F.lit("z") for c in ("payload", "file", "first_id", "value", "hash")}).repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.archive_pages(df, min_bytes=least).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    groups = collections.defaultdict(list)
    for i, _, html in PAGES:
        groups[html or ""].append(i)
    want = []
    for html, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        size = len(html.encode())
        seen = False
        for i in ids:
            again = size >= least and (i != first or seen)
            seen |= i == first
            want.append((i, size, digest(html), "revisit" if again else "response", first if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(df).collect() == []


def test_broken_archive_is_an_error(spark):
    scratch = Scratch(spark, "broken")
    df = spark.createDataFrame([(warc.MAGIC + "WARC-Type: response\r\nContent-Length: 99\r\n\r\nshort\r\n",)], "value string")
    df.write.option("lineSep", warc.CRLF).text(scratch.path("archives"))
    with pytest.raises(ValueError):
        warc.read_archives(spark, scratch.path("archives"), scratch)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", SF])
def test_recall(spark, sf):
    got = collections.defaultdict(list)
    for r in sorted(neighbours.op9_neighbours(spark, sf).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    rows = sorted((r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        found = got[int(ids[q])]
        assert len(found) == 20 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(abs(scores[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for v, s in found)
        hits.append(len(set(best) & {v for v, _ in found}) / 20)
    assert len(hits) == len(got) and np.mean(hits) >= 0.9


def brute_nearest(rows, k):
    seen = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v) and len(v) == 2:
            seen[i] = min(seen.get(i, v), v)
    out = []
    for q in (i for i in seen if i % 20 == 0):
        best = sorted(((-float(np.dot(seen[q], v)), i) for i, v in seen.items() if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_neighbours_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [inf, 1.0]), (6, [1.0, 2.0, 3.0]),
            (20, [3.0, 4.0]), (20, [3.0, 4.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (None, [1.0, 1.0]), (9, [nan, 1.0]), (10, []),
            (40, [-1.0, 2.0]), (41, [1e-3, 1e-3]), (42, [500.0, -3.0]), (20, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit(1) for c in ("id", "vector", "norm", "block", "score")})
    for k in (3, 20):
        got = neighbours.nearest(df, F.col("id") % 20 == 0, k=k).collect()
        got, want = sorted(map(tuple, got)), brute_nearest(rows, k)
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert np.allclose([r[3] for r in got], [r[3] for r in want])
    assert neighbours.nearest(df.limit(0), F.col("id") % 20 == 0).collect() == []


def test_hot_cell_is_split(spark):
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(300)] + [(300 + i, [float(i), -1.0, 2.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("id") == 0, k=5, block_rows=16).collect()
    x = np.array([r[1] for r in rows])
    scores = x @ x[0]
    scores[0] = -np.inf
    want = np.lexsort((np.arange(len(rows)), -scores))[:5].tolist()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == want


def unequal(name, n=2000):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 100 if name == "width" else 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if name == "outlier":
        x[7] *= 2
    elif name == "few":
        x[rng.permutation(n)[:4]] *= 3
    else:
        x *= rng.uniform(*((0.99, 1.01) if name == "close" else (0.5, 2)), size=(n, 1))
    return x


@pytest.mark.parametrize("name", ["close", "outlier", "few", "spread", "width"])
def test_recall_at_unequal_lengths(spark, name):
    x = unequal(name)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.nearest(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in range(0, len(x), 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits.append(len(set(np.argsort(-scores)[:20].tolist()) & got[q]) / 20)
    assert np.mean(hits) >= 0.9
