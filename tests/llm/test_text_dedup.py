"""Operators 1, 5 and 8 against brute force."""

import collections
import hashlib
import re

import pytest

from quarry.llm import exact_dedup, line_dedup, ngram_join
from quarry.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, lower=True):
    w = WORD.findall((text or "").translate(LOWER) if lower else text or "")
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def linked(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 75 * (len(a) + len(b) - both)


def brute_components(rows):
    """rows (id, text) -> (id, n, smallest id reachable) per row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            least[r] = min(least.get(r, doc), doc)
    return [(doc, len(sets[i]), least.get(find(i), doc)) for i, (doc, _) in enumerate(rows)]


def key(rows):
    return sorted(rows, key=str)


def edited(base, every):
    words = base.split()
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(words))


@pytest.fixture(scope="module")
def near_docs(spark):
    """Chains and groups of near copies around the threshold."""
    rows, n = [], 0
    for g in range(6):
        base = " ".join(f"g{g}w{i * 7 % 101}" for i in range(90))
        for every in (30, 31, 45, 60, 89, 22, 18, 15, 12):
            rows.append((n, edited(base, every)))
            n += 1
        rows.append((n, base + " tail " * g))
        rows.append((n + 1, base))
        n += 2
    passage = " ".join(f"shared{i}" for i in range(55))
    for i in range(60):  # a passage in many otherwise different documents
        rows.append((n, " ".join(f"own{i}x{k}" for k in range(40 + i)) + " " + passage))
        n += 1
    return rows


def test_components_match_brute_force(spark, near_docs):
    df = spark.createDataFrame(near_docs, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.jaccard_components(df).collect()]
    assert key(got) == key(brute_components(near_docs))


def test_components_with_large_groups_split_into_blocks(spark, near_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT_SETS", 1)
    df = spark.createDataFrame(near_docs, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.jaccard_components(df).collect()]
    assert key(got) == key(brute_components(near_docs))


def test_components_of_a_table(spark):
    docs = table(spark, SF, "documents", "doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = [tuple(r) for r in ngram_join.jaccard_components(docs).collect()]
    assert key(got) == key(brute_components(rows))


def test_components_of_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in ngram_join.jaccard_components(odd_docs).collect()]
    assert key(got) == key(brute_components(rows))
    assert ngram_join.jaccard_components(no_docs).collect() == []
    kept = ngram_join.one_per_component(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = collections.Counter(r.doc_id for r in kept.select("doc_id").collect())
    # of the copies of the prose one row with id 1 stays; texts without words stay
    assert ids[1] == 1 and ids[2] == ids[3] == 0 and ids[4] == ids[5] == ids[6] == 1 and ids[None] == 1 and ids[12] == 2
    assert ngram_join.one_per_component(no_docs).collect() == []


def brute_lines(rows):
    """rows (id, text) -> texts after dedup, per row; equal rows are one document."""
    order = sorted(set(r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0))
    seen, gone = [], set()
    for row in order:
        for k, line in enumerate(row[1].split("\n")):
            s = shingles(line, lower=False)
            if not s:
                continue
            if any(linked(s, t) for t in seen):
                gone.add((row, k))
            seen.append(s)
    return [(i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if ((i, t), k) not in gone))
            for i, t in rows]


def test_lines_match_brute_force(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"{line}\nshort one\n\n{line}"), (2, f"{edited(line, 40)}\nshort one\nunique words in this line"),
            (3, f"{edited(line, 20)}\n{edited(line, 9)}"), (0, f"intro\n{edited(line, 39)} more"),
            (5, "a b c d e f\na b c d e g\na b c d e f"), (6, " leading  space\nleading space")]
    rows += [(10 + i, f"{edited(line, 25 + i)}\ntext {i} of its own\n{line}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in line_dedup.dedup_lines(df).collect()]
    assert key(got) == key(brute_lines(rows))


def test_lines_of_odd_rows(spark, odd_docs, no_docs):
    out = line_dedup.dedup_lines(odd_docs, counts=False)
    assert out.columns == odd_docs.columns
    # id 12 has two texts: ties are broken by the texts' hashes, so compare without them
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").where("doc_id <> 12 or doc_id is null").collect()]
    rest = odd_docs.where("doc_id <> 12 or doc_id is null")
    got = [tuple(r) for r in line_dedup.dedup_lines(rest).select("doc_id", "text").collect()]
    assert key(got) == key(brute_lines(rows))
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_lines_of_small_sets_and_frequent_tokens(spark, monkeypatch):
    """Repeated shingles, sets of 1 to 4 tokens, lines past the exact sizes, a passage in many lines, white space."""
    monkeypatch.setattr(line_dedup, "SAMPLE", 1)
    monkeypatch.setattr(line_dedup, "MANY", 3)
    passage = " ".join(f"p{i}" for i in range(12))
    long = " ".join(f"l{i}" for i in range(400))
    rows = [(i, f"{' '.join(f'o{i}x{k}' for k in range(i % 7))} {passage} e{i % 5}") for i in range(40)]
    rows += [(50, "a b c d e f g\n\u00e4 b\tc  d"), (51, "a b c d e f g h\na b c\r\na b c"), (52, "b c d e f g h\n\u00e4 b c d"),
             (53, "z " * 30 + "\n" + "z " * 9), (54, "q r " * 9), (55, "r q " * 9), (None, f"{long}\na b c d e f g h"),
             (56, edited(long, 90)), (57, edited(long, 15)), (58, long + " " + passage), (57, edited(long, 15))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in line_dedup.dedup_lines(df).collect()]
    assert key(got) == key(brute_lines(rows))


def test_line_dedup_is_native(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("Python on the executors")

    df = spark.createDataFrame([(1, "a b c d e f g h\nown words"), (2, "a b c d e f g h i")], "doc_id long, text string")
    monkeypatch.setattr(type(df), "mapInArrow", refuse)
    out = line_dedup.dedup_lines(df)
    assert key(tuple(r) for r in out.collect()) == key([(1, "a b c d e f g h\nown words"), (2, "")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        digest = hashlib.sha256(t.encode()).hexdigest()
        left = [first] if first in ids else []
        for i in ids:
            kept = bool(left) and i == left[0]
            if kept:
                left.pop()
            out.append((i, first, len(ids), kept, digest))
    return out


@pytest.mark.parametrize("heavy", [1, 1000])
def test_exact_dedup_of_odd_rows(spark, odd_docs, no_docs, heavy):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in exact_dedup.exact_dedup(odd_docs, heavy=heavy).collect()]
    assert key(got) == key(brute_exact(rows))
    assert exact_dedup.exact_dedup(no_docs).collect() == []


def test_exact_dedup_is_native(spark):
    plan = exact_dedup.op5_exact_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan
