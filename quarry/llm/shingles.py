"""Word shingles of whole texts as 64-bit hashes, vectorised over a batch.

A word is a maximal run of characters other than space and TAB..CR
(``[^\\x20\\x09-\\x0D]+``); A-Z is lower-cased first. All of these are ASCII,
so the work is done on UTF-8 bytes. A word's hash is a polynomial over its
bytes modulo 2^64, taken from one running sum over the batch; a shingle's
hash combines the mixed hashes of its words in order.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CHUNK = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)


_POW = _powers(_BASE, _CHUNK)
_INV = _powers(_BASE_INV, _CHUNK)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers (splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte run of ``data`` (at most ``_CHUNK`` bytes)."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POW[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * _INV[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of UTF-8 bytes."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = _SPACE[data]
    return np.flatnonzero(gap[:-2] & ~gap[1:-1]), np.flatnonzero(~gap[1:-1] & gap[2:]) + 1


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word; a slice of whole words at a time keeps powers and sums small."""
    if len(data) <= _CHUNK:
        return _hash_runs(data, starts, ends)
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        if hi - lo > _CHUNK:  # one word longer than the slice: chain its pieces
            h = np.zeros(1, dtype=np.uint64)
            for p in range(lo, hi, _CHUNK):
                piece = data[p:min(p + _CHUNK, hi)]
                with np.errstate(over="ignore"):
                    h = mix(h * _BASE + _hash_runs(piece, np.array([0]), np.array([len(piece)])))
            out.append(h)
        else:
            out.append(_hash_runs(data[lo:hi], starts[i:j] - lo, ends[i:j] - lo))
        i = j
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of one UTF-8 text, A-Z lower-cased, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    data = _LOWER[raw]
    return hash_words(data, *word_spans(data))


def chained(words: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position in ``first``."""
    with np.errstate(over="ignore"):
        acc = np.full(len(first), width, dtype=np.uint64)
        for i in range(width):
            acc = mix(acc * _BASE + words[first + i])
    return acc


def line_shingles(text: bytes, width: int = 5) -> tuple[np.ndarray, np.ndarray, int]:
    """All shingles of all lines of a text at once: hashes, the line of each
    (not in order), and the number of lines. Words are taken as they are."""
    data = np.frombuffer(text, dtype=np.uint8)
    breaks = np.flatnonzero(data == 10)
    starts, ends = word_spans(data)
    words = hash_words(data, starts, ends)
    line = np.searchsorted(breaks, starts)
    count = np.bincount(line, minlength=len(breaks) + 1)
    first = np.cumsum(count) - count
    hashes, lines = [], []
    if len(words) >= width:
        full = np.flatnonzero(line[width - 1:] == line[:len(line) - width + 1])
        hashes.append(chained(words, full, width))
        lines.append(line[full])
    for k in range(1, width):  # shorter lines are one shingle
        short = np.flatnonzero(count == k)
        hashes.append(chained(words, first[short], k))
        lines.append(short)
    return np.concatenate(hashes), np.concatenate(lines), len(breaks) + 1


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of one text. With fewer words than
    ``width`` the whole sequence is one shingle; no words give none."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(width, len(words))
    with np.errstate(over="ignore"):
        acc = np.full(len(words) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            acc = mix(acc * _BASE + words[i:len(words) - k + 1 + i])
    return np.unique(acc)
