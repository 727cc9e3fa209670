"""A cover tree over norm-augmented integer vectors, searched best first.

Each vector x gets a further coordinate sqrt(M^2 - |x|^2), M the largest norm
of the tree, so that all lie on a sphere of radius M and an inner product with
(q, 0) is the one with x. A node has a centre, which is one of its vectors, and
a covering radius: the largest distance of its vectors from the centre. Children
are a farthest-first net of the node's vectors, the node's centre first: they
cover at half the radius (or at what ``FAN`` centres reach), and their centres are
at least that far apart. A leaf holds at most ``LEAF`` vectors, or equal ones.

On the sphere a covering radius is an angle, so the angle between a query and
the centre bounds the inner products in the node from both sides. The bounds only
skip nodes; what is found is scored exactly in integers.
"""

from __future__ import annotations

import io

import numpy as np

FAN = 16
LEAF = 64
EXACT = 2.0 ** 53


def augmented(vectors: np.ndarray, most: float) -> np.ndarray:
    """The vectors as points of the sphere of radius ``most``."""
    x = vectors.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))])


def angle(radius, most: float):
    """The angle seen from the centre of the sphere across a chord."""
    return 2 * np.arcsin(np.minimum(1, radius / (2 * most))) if most else np.zeros_like(radius)


def inner_bounds(queries: np.ndarray, norms: np.ndarray, centres: np.ndarray, angles: np.ndarray, most: float):
    """(least, largest) inner product that vectors within ``angles`` of each of the
    ``centres`` may have with each query, widened by the error of the arithmetic."""
    scale = norms[:, None] * most
    off = np.arccos(np.clip(queries @ centres.T / np.maximum(scale, 1e-300), -1, 1))
    slack = 1e-7 * scale + 1e-6
    return scale * np.cos(np.minimum(np.pi, off + angles)) - slack, scale * np.cos(np.maximum(0, off - angles)) + slack


def net(points: np.ndarray, fan: int, goal: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Farthest-first centres from point 0 until all points are within ``goal``
    of one or there are ``fan``; the centre of each point and its distance."""
    chosen, owner = [0], np.zeros(len(points), dtype=np.int64)
    near = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(chosen) < fan:
        far = int(near.argmax())
        if near[far] <= goal or near[far] == 0:
            break
        away = np.sqrt(((points - points[far]) ** 2).sum(axis=1))
        closer = away < near
        owner[closer], near[closer] = len(chosen), away[closer]
        owner[far], near[far] = len(chosen), 0
        chosen.append(far)
    return chosen, owner, near


class CoverTree:
    """``vectors`` (n, d) integers, ``labels`` (n,), and for each vector the ids
    ``ids[at[i]:at[i + 1]]``, smallest first."""

    ARRAYS = ("vectors", "labels", "at", "ids", "rows", "no_id", "centres", "radii", "first", "size", "lo", "hi", "only")

    def __init__(self, **arrays):
        for name in self.ARRAYS:
            setattr(self, name, arrays[name])
        self.most = float(np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1).max()))
        self.points = augmented(self.vectors, self.most)
        self.plain = self.points[:, :-1]
        self.angles = angle(self.radii, self.most)

    @classmethod
    def build(cls, vectors, labels, at, ids, rows, no_id) -> CoverTree:
        most = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max()))
        points = augmented(vectors, most)
        order = np.arange(len(vectors))  # vectors of a node are neighbours in this order, its centre first
        centres, radii, first, size, lo, hi, only = [], [], [], [], [], [], []

        def add(a: int, b: int) -> int:
            """The node of the vectors at a to b in the order."""
            own = order[a:b]
            centres.append(int(own[0]))
            radii.append(float(np.sqrt(((points[own] - points[own[0]]) ** 2).sum(axis=1).max())))
            held = labels[own]
            only.append(bool((held == held[0]).all()))
            first.append(0)
            size.append(0)
            lo.append(a)
            hi.append(b)
            return len(centres) - 1

        waiting = [add(0, len(vectors))]
        while waiting:
            node = waiting.pop()
            a, b = lo[node], hi[node]
            if b - a <= LEAF or radii[node] == 0:
                continue
            own = order[a:b]
            chosen, owner, _ = net(points[own], FAN, radii[node] / 2)
            lead = np.ones(b - a, dtype=np.int64)
            lead[chosen] = 0
            order[a:b] = own[np.lexsort((lead, owner))]
            ends = a + np.cumsum(np.bincount(owner, minlength=len(chosen)))
            starts = np.append(a, ends[:-1])
            # children are added in a row, so that a node names them by the first
            first[node], size[node] = len(centres), len(chosen)
            waiting.extend([add(int(x), int(y)) for x, y in zip(starts, ends)])
        place = np.argsort(order)
        many = np.diff(at)[order]
        move = np.repeat(at[:-1][order] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return cls(vectors=vectors[order], labels=labels[order], at=np.append(0, np.cumsum(many)), ids=ids[move],
                   rows=rows[move], no_id=no_id[move], centres=place[np.array(centres)], radii=np.array(radii),
                   first=np.array(first), size=np.array(size), lo=np.array(lo), hi=np.array(hi), only=np.array(only))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.ARRAYS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{name: arrays[name] for name in cls.ARRAYS})

    def search(self, queries: np.ndarray, labels: np.ndarray, same: bool, lows: list[list[int]], highs: list[list[int]],
               floors: list[list[int]], k: int) -> list[list[list[tuple]]]:
        """For each of the ``queries`` (rows of a matrix) and each of its windows (low,
        high) the first ``k`` of the vectors with (or, if not ``same``, without) the
        query's label whose inner product lies in the window and is not below its
        floor, as (-score, no id, id, row), the best first.

        The queries descend together, each best first by its own bounds: it opens its
        best node, then its two best, then four, so that a query leaves few nodes open
        that a strict order would not, and nodes and leaves are met by many queries at a time."""
        n, most = len(queries), max(map(len, lows))
        real = queries.astype(np.float64)
        norms = np.sqrt((real * real).sum(axis=1))
        need, high = np.full((n, most), np.inf), np.full((n, most), -np.inf)  # what a score must reach, and may be
        exact_need, exact_high = np.ones((n, most), dtype=np.int64), np.zeros((n, most), dtype=np.int64)
        for i in range(n):
            for w, (lo, hi, floor) in enumerate(zip(lows[i], highs[i], floors[i])):
                exact_need[i, w], exact_high[i, w] = max(lo, floor), hi
                need[i, w], high[i, w] = max(lo, floor), hi
        least, largest = self._bounds(real, norms)
        # floats hold every partial sum of such an inner product exactly
        exact = norms.max() * self.most < EXACT
        held = self.labels[self.lo]
        admitted = ~self.only[None, :] | ((held[None, :] == labels[:, None]) == same)  # labels leave something to find
        agenda = np.zeros(largest.shape, dtype=bool)
        agenda[:, 0] = True
        window, score, vector = (np.zeros(0, dtype=np.int64) for _ in range(3))
        width = 1
        while True:
            opens = np.zeros(agenda.shape, dtype=bool)
            for w in range(most):
                opens |= (need[:, w, None] <= largest) & (high[:, w, None] >= least)
            agenda &= opens & admitted
            if not agenda.any():
                break
            best = np.where(agenda, largest, -np.inf)
            if width < best.shape[1]:
                cut = -np.partition(-best, width - 1, axis=1)[:, width - 1]
                chosen = agenda & (best >= cut[:, None])
            else:
                chosen = agenda.copy()
            agenda &= ~chosen
            found = []
            for node in np.flatnonzero(chosen.any(axis=0)):
                who = np.flatnonzero(chosen[:, node])
                if self.size[node]:
                    agenda[who[:, None], np.arange(self.first[node], self.first[node] + self.size[node])[None, :]] = True
                    continue
                a, b = int(self.lo[node]), int(self.hi[node])
                scores = (real[who] @ self.plain[a:b].T).astype(np.int64) if exact else queries[who] @ self.vectors[a:b].T
                fits = (self.labels[None, a:b] == labels[who, None]) == same
                fits &= (scores >= exact_need[who].min(axis=1, where=need[who] < np.inf, initial=np.iinfo(np.int64).max)[:, None])
                fits &= scores <= exact_high[who].max(axis=1, where=high[who] > -np.inf, initial=np.iinfo(np.int64).min)[:, None]
                i, j = np.nonzero(fits)
                found.append((who[i], scores[i, j], a + j))
            width *= 2
            if not found:
                continue
            q, s, v = (np.concatenate(x) for x in zip(*found))
            # hits by window, with what was found before
            parts = [(window, score, vector)]
            for w in range(most):
                ok = (s >= exact_need[q, w]) & (s <= exact_high[q, w])
                parts.append((q[ok] * most + w, s[ok], v[ok]))
            window, score, vector = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((-score, window))
            window, score, vector = window[order], score[order], vector[order]
            start = np.flatnonzero(np.append(True, window[1:] != window[:-1])) if len(window) else np.zeros(0, np.int64)
            full = start[np.diff(np.append(start, len(window))) >= k]
            # every vector has an id, so the k-th score bounds what can still count
            at = window[full]
            exact_need[at // most, at % most] = score[full + k - 1]
            need[at // most, at % most] = score[full + k - 1]
            keep = score >= exact_need[window // most, window % most]
            window, score, vector = window[keep], score[keep], vector[keep]
        out: list[list[list[tuple]]] = [[[] for _ in own] for own in lows]
        for w, s, v in zip(window.tolist(), score.tolist(), vector.tolist()):
            a = int(self.at[v])
            out[w // most][w % most].extend((-s, bool(self.no_id[j]), int(self.ids[j]), int(self.rows[j]))
                                            for j in range(a, min(int(self.at[v + 1]), a + k)))
        return [[sorted(found)[:k] for found in own] for own in out]

    def _bounds(self, real: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) inner product of each query with each node's vectors."""
        return inner_bounds(real, norms, self.plain[self.centres], self.angles, self.most)
