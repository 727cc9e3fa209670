"""Operators 2, 3 and 10: packing, mixing, token matrices."""

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing, packing, token_binary
from quarry.llm.common import Scratch, table

SF = "/root/testdata/sf0.001"


def test_bucket_bounds_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        n, k = rng.randint(1, 8), rng.randint(1, 5)
        lengths = sorted(rng.sample(range(1, 30), n))
        counts = [rng.randint(1, 9) for _ in lengths]

        def cost(bounds):
            return sum(c * min(b for b in bounds if b >= x) for x, c in zip(lengths, counts))

        best = min(cost((*cut, lengths[-1])) for r in range(min(k, n)) for cut in itertools.combinations(lengths[:-1], r))
        got = packing.bucket_bounds(lengths, counts, k)
        assert len(got) <= k and cost(got) == best


def check_layout(rows, words, max_length, buckets, budget):
    spans = collections.defaultdict(list)
    for r in rows:
        spans[r.doc_id].append(r)
    for doc, n in words.items():
        pieces = sorted(spans[doc], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == n
        assert [r.start for r in pieces] == [max_length * i for i in range(len(pieces))]
    packed = [r for r in rows if r.length]
    assert all((r.batch is None) == (r.length == 0) for r in rows)
    batches = collections.defaultdict(list)
    for r in packed:
        assert r.length <= r.bucket_length
        batches[r.bucket_length, r.batch].append(r.slot)
    assert len({b for b, _ in batches}) <= buckets
    for (bound, batch), slots in batches.items():
        full = budget // bound
        last = max(b for x, b in batches if x == bound)
        assert sorted(slots) == list(range(len(slots))) and (len(slots) == full or batch == last and len(slots) <= full)
    lengths = collections.Counter(r.length for r in packed)
    bounds = packing.bucket_bounds(sorted(lengths), [lengths[x] for x in sorted(lengths)], buckets)
    assert {b for b, _ in batches} == set(bounds)


def test_layout_of_a_table(spark):
    docs = table(spark, SF, "documents", "doc_id", "text")
    words = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    check_layout(packing.pack_layout(docs, max_length=100, buckets=5, token_budget=700).collect(), words, 100, 5, 700)


def test_layout_of_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack_layout(odd_docs).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.doc_id] += r.length
    assert sizes[10] == 20_000 and sizes[4] == sizes[5] == sizes[6] == 0 and sizes[1] == 240 and sizes[8] == 3
    assert all(r.batch is None for r in rows if r.doc_id in (4, 5, 6))
    assert packing.pack_layout(no_docs).collect() == []
    with pytest.raises(ValueError):
        packing.pack_layout(odd_docs, max_length=10, token_budget=5)


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([200, 500 / 3, 250 / 3])
    got = mixing.targets([1000, 10, 10, 0], [5, 2, 1, 5])
    assert sum(got) == pytest.approx(1530) and all(g <= 2 * s for g, s in zip(got, [1000, 10, 10, 0]))
    assert got[1:] == [20, 20, 0]
    assert mixing.targets([], []) == []


def test_splitting_tree_keeps_quotas():
    quotas = np.array([50, 0, 7, 1000])
    split = mixing.split_quotas(quotas, 7)
    assert (split.sum(axis=0) == quotas).all() and (split >= 0).all()
    assert (split == mixing.split_quotas(quotas, 7)).all()
    sums = split.sum(axis=1)
    assert sums.max() - sums.min() <= 7  # halves are exact, so shards are even
    dealt = mixing.deal_blocks(list(quotas), 7)
    assert len({(s, b) for s, b, _ in dealt}) == len(dealt) == quotas.sum()


def test_mix_of_a_table(spark):
    rows = mixing.op3_mixing(spark, SF).collect()
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    taken, target = collections.Counter(), {}
    for r in rows:
        assert r.size == len(docs[r.doc_id].text.split()) and 0 <= r.taken <= 2 * r.size
        taken[docs[r.doc_id].source] += r.taken
        target[docs[r.doc_id].source] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    # ten documents a source: the sums that whole documents allow are coarse
    most = collections.Counter()
    for d in docs.values():
        most[d.source] = max(most[d.source], len(d.text.split()))
    assert all(abs(taken[s] - t) <= 0.5 * most[s] for s, t in target.items())
    again = {r.doc_id: r.taken for r in mixing.op3_mixing(spark, SF).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_copies_are_drawn_once(spark):
    sizes = mixing.document_sizes(table(spark, SF, "documents"), Scratch(spark, "t"))
    rows, plan = mixing.plan_mix(sizes, Scratch(spark, "t"))
    drawn = mixing.draw(rows, plan, shards=5, block_words=200)
    assert drawn.count() == rows.agg(F.sum("copies")).first()[0]
    assert drawn.select("row", "copy").distinct().count() == drawn.count()
    words = [r.w for r in drawn.groupBy("shard").agg(F.sum("size").alias("w")).collect()]
    assert len(words) == 5 and max(words) < 2 * min(words)


def long_and_short(spark):
    """Sources of 2,000 short documents and three very long ones, which leave
    gaps of hundreds of documents."""
    rng = np.random.default_rng(3)
    rows = []
    for s in range(12):
        sizes = [*rng.integers(50, 401, 2000).tolist(), 150_000, 150_000, 150_000]
        rows += [(s * 10_000 + i, f"s{s:02}", n) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n int")
    return docs.select("doc_id", "source", F.expr("trim(repeat('w ', n))").alias("text"))


def test_gaps_of_long_documents_are_closed(spark):
    sizes = mixing.document_sizes(long_and_short(spark), Scratch(spark, "t"))
    rows, plan = mixing.plan_mix(sizes, Scratch(spark, "t"))
    got = {r["index"]: r for r in rows.groupBy("index").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("copies").alias("most"), F.count(F.lit(1)).alias("n")).collect()}
    off = {p["index"]: abs(got[p["index"]].taken - p["target"]) / p["target"] for p in plan}
    assert len(got) == 12 and all(r.n == 2003 and r.most <= 2 for r in got.values())
    assert max(off.values()) < 0.01, off


def test_only_blocks_with_copies_are_dealt(spark):
    # source b takes a tenth of its line, the blocks of the rest hold nothing
    rows = [(i, "a", 50) for i in range(400)] + [(1000 + i, "b", 50) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").selectExpr(
        "int(source = 'b') AS index", "if(source = 'b', 200000L, 20000L) AS source_size", "size", "doc_id AS h", "doc_id AS row",
        "doc_id % 1000 * 50 + if(source = 'b', floor((doc_id - 1000) / 1000) * 50000, 0) AS start",
        "if(source = 'b', int(doc_id < 1400), 1) AS copies")
    plan = [{"target": 20_000.0, "full": 1, "source_size": 20_000}, {"target": 20_000.0, "full": 0, "source_size": 200_000}]
    drawn = mixing.draw(df, plan, shards=8, block_words=100)
    assert drawn.count() == 800
    words = [r.w for r in drawn.groupBy("shard").agg(F.sum("size").alias("w")).collect()]
    assert words == [5000] * 8  # 400 equal blocks over 8 shards


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    got = collections.Counter((r.doc_id, r.source) for r in out.select("doc_id", "source").collect())
    assert all(k not in {(4, "b"), (5, None), (6, None)} for k in got)
    assert all(n <= 4 for n in got.values())  # two equal rows, two copies each at most
    assert mixing.mixed_documents(no_docs).collect() == []


def test_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        cap = rng.randint(1, 40)
        lengths = np.array([rng.randint(1, cap) for _ in range(rng.randint(0, 60))], dtype=np.int64)
        rows = token_binary.best_fit_decreasing(lengths, cap)
        rooms = []
        for n in sorted(lengths.tolist(), reverse=True):  # the same rule by linear search
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else cap) - n)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(cap - int(lengths[r].sum()) for r in rows) == sorted(rooms)


def read_texts(matrix, tokenizer, row_tokens):
    """Decode a packed matrix back to (doc_id, task, doc) -> text."""
    parts = collections.defaultdict(list)
    for r in matrix.collect():
        ids = np.frombuffer(r.ids, dtype="<u2")
        assert len(ids) == row_tokens and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= row_tokens
        assert (ids[r.cu_seqlens[-1]:] == tokenizer.n_vocab).all()
        for s, a, b in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:]):
            parts[s.doc_id, r.task, s.doc].append((s.resumes_at, ids[a:b]))
    out = []
    for (doc, _, _), pieces in parts.items():
        pieces.sort(key=lambda p: p[0])
        assert [p for p, _ in pieces] == np.cumsum([0] + [len(x) for _, x in pieces[:-1]]).tolist()
        out.append((doc, tokenizer.decode(np.concatenate([x for _, x in pieces]).tolist())))
    return sorted(out, key=str)


def test_token_matrix_round_trip(spark, odd_docs, no_docs):
    with open(token_binary.vocabulary_path(), "rb") as f:
        vocabulary = f.read()
    tokenizer = token_binary.load_tokenizer(vocabulary)
    for docs, row_tokens, buffer in ((table(spark, SF, "documents"), 64, 3000), (odd_docs, 256, 10_000)):
        matrix = token_binary.packed_matrix(docs, vocabulary, row_tokens=row_tokens, buffer_tokens=buffer)
        want = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.text), key=str)
        assert read_texts(matrix, tokenizer, row_tokens) == want
    assert token_binary.packed_matrix(no_docs, vocabulary).collect() == []


def test_long_texts_encode_as_a_whole():
    with open(token_binary.vocabulary_path(), "rb") as f:
        tokenizer = token_binary.load_tokenizer(f.read())
    text = " ".join(f"token{i} slice" for i in range(60_000))
    assert token_binary.encode(tokenizer, text).tolist() == tokenizer.encode_ordinary(text)
