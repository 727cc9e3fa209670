"""Signature trees: OR-combined token bitmaps and size ranges, traversed in
pairs.

A set's signature has one bit per token hash. Two sets share at most as many
tokens as their signatures share bits, plus the tokens that fall on bits
already taken in the set with fewer such collisions. A node holds the OR of
its members' signatures, the range of their sizes, their most collisions and
the range of their labels, so the same formula bounds the overlap of any pair
of sets below two nodes. Pairs of nodes whose bound is too low for the
threshold, or whose members all carry one label already, are not opened.
Sets of a tree are ordered by size class and bitmap, so that similar sets
share nodes and the OR of a node stays close to its members.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS = 2048
FANOUT = 4
_PAIRS_AT_ONCE = 1024


def signature(tokens: np.ndarray) -> np.ndarray:
    """Bitmap (BITS / 8 bytes) of hashed tokens."""
    seen = np.zeros(BITS, dtype=bool)
    seen[(tokens >> np.uint64(20)).astype(np.int64) % BITS] = True
    return np.packbits(seen)


def wide_signature(tokens: np.ndarray) -> np.ndarray | None:
    """Bitmap of four to eight bits a token for sets that fill BITS; None for others."""
    if 4 * len(tokens) <= BITS:
        return None
    width = 1 << (4 * len(tokens) - 1).bit_length()
    seen = np.zeros(width, dtype=bool)
    seen[(tokens >> np.uint64(20)).astype(np.int64) & (width - 1)] = True
    return np.packbits(seen)


def wide_may_link(a: np.ndarray, size_a: int, b: np.ndarray, size_b: int, percent: int) -> bool:
    """The bound for two sets by their wide bitmaps; the wider one is folded to
    the width of the other (positions are the same hash, modulo the width)."""
    width = min(len(a), len(b))
    a = np.bitwise_or.reduce(a.reshape(-1, width), axis=0)
    b = np.bitwise_or.reduce(b.reshape(-1, width), axis=0)
    extra = min(size_a - int(np.bitwise_count(a).sum(dtype=np.int64)), size_b - int(np.bitwise_count(b).sum(dtype=np.int64)))
    shared = min(int(np.bitwise_count(a & b).sum(dtype=np.int64)) + extra, size_a, size_b)
    return (100 + percent) * shared >= percent * (size_a + size_b)


def unpack(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), dtype=np.uint64).reshape(-1, BITS // 64)


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a & b).sum(axis=1, dtype=np.int64)


@dataclass
class Level:
    """Nodes of one level; children are ``first[i]`` .. ``last[i] - 1`` below."""

    bits: np.ndarray
    least: np.ndarray
    most: np.ndarray
    extra: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray


def may_link(a: Level, i: np.ndarray, b: Level, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether some pair of sets below the nodes may reach the threshold:
    100 * shared >= percent * (sizes - shared), with different labels."""
    open_ = ~((a.low[i] == a.high[i]) & (b.low[j] == b.high[j]) & (a.low[i] == b.low[j]))
    open_ &= (100 * a.most[i] >= percent * b.least[j]) & (100 * b.most[j] >= percent * a.least[i])
    shared = shared_bits(a.bits[i], b.bits[j]) + np.minimum(a.extra[i], b.extra[j])
    return open_ & ((100 + percent) * shared >= percent * (a.least[i] + b.least[j]))


def pairs_may_link(bits_a, size_a, bits_b, size_b, percent: int) -> np.ndarray:
    """The bound for pairs of single sets."""
    extra = np.minimum(size_a - np.bitwise_count(bits_a).sum(axis=1, dtype=np.int64),
                       size_b - np.bitwise_count(bits_b).sum(axis=1, dtype=np.int64))
    shared = np.minimum(shared_bits(bits_a, bits_b) + extra, np.minimum(size_a, size_b))
    return (100 + percent) * shared >= percent * (size_a + size_b)


def bit_jaccard(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared and united bits of pairs of signatures."""
    return shared_bits(bits[i], bits[j]), np.bitwise_count(bits[i] | bits[j]).sum(axis=1, dtype=np.int64)


def arrangement(bits: np.ndarray, sizes: np.ndarray, ids: np.ndarray, work: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Order of sets within (work, side): size class, then the first words of
    the bitmap. Their lowest set bits are the set's smallest hashes, which similar
    sets are likely to have in common."""
    klass = np.floor(np.log2(np.maximum(sizes, 1)) * 2).astype(np.int64)
    return np.lexsort((ids, *(bits[:, k].byteswap() for k in (3, 2, 1, 0)), klass, side, work))


class Forest:
    """Picks a forest of pairs over labels, the most similar pairs first within
    a call; pairs between labels that are joined already are left out. A call
    costs as much as the pairs it is given, however many labels there are."""

    def __init__(self, labels: np.ndarray):
        known, self.node = np.unique(labels, return_inverse=True)
        self.root = np.arange(len(known))

    def _roots(self, nodes: np.ndarray) -> np.ndarray:
        top = self.root[nodes]
        while (self.root[top] != top).any():
            top = self.root[top]
        self.root[nodes] = top
        return top

    def take(self, i: np.ndarray, j: np.ndarray, shared: np.ndarray, united: np.ndarray, percent: int):
        likely = 100 * shared >= percent * united
        i, j = i[likely], j[likely]
        order = np.argsort(-(shared[likely] / united[likely]), kind="stable")
        i, j = i[order], j[order]
        taken_i, taken_j = [i[:0]], [j[:0]]
        while True:
            u, v = self._roots(self.node[i]), self._roots(self.node[j])
            apart = u != v
            i, j, u, v = i[apart], j[apart], u[apart], v[apart]
            if not len(i):
                return np.concatenate(taken_i), np.concatenate(taken_j)
            # each root's first pair; a pair picked from both ends counts once
            ends, first = np.unique(np.stack([u, v], axis=1).reshape(-1), return_index=True)
            pick = np.unique(first // 2)
            taken_i.append(i[pick])
            taken_j.append(j[pick])
            # a root hangs below the other end of its first pair; of two that
            # picked each other the smaller stays a root
            self.root[ends] = u[first // 2] + v[first // 2] - ends
            tops = ends[(self.root[self.root[ends]] == ends) & (ends < self.root[ends])]
            self.root[tops] = tops


def build(bits: np.ndarray, sizes: np.ndarray, labels: np.ndarray, trees: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """Levels from the sets (ordered by tree, then ``arrangement``) up to one root per
    tree; and the tree of each root."""
    n = len(sizes)
    extra = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    here = Level(bits, sizes, sizes, extra, labels, labels, np.arange(n), np.arange(n) + 1)
    levels, of = [here], trees
    while len(of) and (of[1:] == of[:-1]).any():
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        within = np.arange(len(of)) - np.repeat(start, np.diff(np.append(start, len(of))))
        first = np.flatnonzero(within % FANOUT == 0)
        here = Level(np.bitwise_or.reduceat(here.bits, first, axis=0), np.minimum.reduceat(here.least, first),
                     np.maximum.reduceat(here.most, first), np.maximum.reduceat(here.extra, first),
                     np.minimum.reduceat(here.low, first), np.maximum.reduceat(here.high, first),
                     first, np.append(first[1:], len(of)))
        of = of[first]
        levels.append(here)
    return levels, of


def dual_traversal(levels: list[Level], roots_a: np.ndarray, roots_b: np.ndarray, percent: int):
    """Yield (i, j) arrays of set numbers that may link, from pairs of roots.
    A pair of equal roots stands for the pairs within that tree."""
    top = len(levels) - 1
    stack = [(top, roots_a[i:i + _PAIRS_AT_ONCE], roots_b[i:i + _PAIRS_AT_ONCE])
             for i in range(0, len(roots_a), _PAIRS_AT_ONCE)]
    while stack:
        depth, a, b = stack.pop()
        level = levels[depth]
        keep = may_link(level, a, level, b, percent)
        if depth == 0:
            keep &= a != b
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if depth == 0:
            yield a, b
            continue
        wide_a, wide_b = level.last[a] - level.first[a], level.last[b] - level.first[b]
        count = wide_a * wide_b
        pair = np.repeat(np.arange(len(a)), count)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        ca, cb = level.first[a][pair] + nth // wide_b[pair], level.first[b][pair] + nth % wide_b[pair]
        once = (a[pair] != b[pair]) | (ca <= cb)
        ca, cb = ca[once], cb[once]
        for i in range(0, len(ca), 16 * _PAIRS_AT_ONCE):
            stack.append((depth - 1, ca[i:i + 16 * _PAIRS_AT_ONCE], cb[i:i + 16 * _PAIRS_AT_ONCE]))
