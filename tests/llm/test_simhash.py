"""Operator 13 against brute force."""

import random
import re

import pytest
import xxhash

from quarry.llm import simhash
from quarry.llm.common import Scratch, table
from quarry.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=2):
    """The class of each fingerprint by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    least: dict = {}
    groups = classes(prints)
    for (doc, _), g in zip(rows, groups):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    return sorted(((doc, f"{p:016x}", least.get(g, doc)) for (doc, _), p, g in zip(rows, prints, groups)), key=str)


def check(spark, df, rows):
    got = simhash.simhash_components(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_whole_table(spark):
    docs = table(spark, SF, "documents", "doc_id", "text")
    check(spark, docs, [tuple(r) for r in docs.collect()])


def test_near_copies(spark):
    draw, rows = random.Random(1), []
    for g in range(12):
        words = [f"w{draw.randrange(400)}" for _ in range(700)]
        for copy in range(9):
            own = list(words)
            for _ in range(copy // 2):
                own[draw.randrange(700)] = f"edit{draw.randrange(9)}"
            rows.append((len(rows) * 7 % 1000, " ".join(own) if copy % 2 else "\n ".join(own).upper()))
    prints = [fingerprint(t) for _, t in rows]
    assert len(set(classes(prints))) < len(set(prints))  # some links are between different texts
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows)


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert simhash.simhash_components(no_docs).collect() == []


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_connect_all_within_the_radius(spark, radius):
    draw = random.Random(radius)
    prints = set()
    for _ in range(8):
        seed = draw.getrandbits(64)
        for _ in range(14):  # a walk of small steps, and points around it
            prints.add(seed)
            for bit in draw.sample(range(64), draw.randrange(4)):
                seed ^= 1 << bit
    prints = sorted(prints) + ([0, (1 << 64) - 1, 1 << 63] if radius else [])
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), radius)
    pairs = [tuple(r) for r in found.collect()]
    assert len(set(pairs)) == len(pairs) and all(0 < ((u ^ v) & (2**64 - 1)).bit_count() <= radius for u, v in pairs)
    label = {}
    if pairs:
        label = {r.node: r.label for r in components(found, Scratch(spark, "test"), "t").collect()}
    got = [label.get(p, p) for p in signed]
    want = classes(prints, radius)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_a_variant_has_a_bounded_group(spark):
    """All fingerprints of a ball meet in the group of its centre, and no group is larger."""
    ball = [0] + [1 << b if b < 63 else -(1 << 63) for b in range(64)]
    assert simhash.links(spark.createDataFrame([(p,) for p in ball], "fp long")).count() >= 64
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)
