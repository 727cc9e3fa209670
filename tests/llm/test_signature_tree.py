"""The bound by bitmaps of a width by the set's size."""

import numpy as np
import pytest

from quarry.llm import signature_tree as tree


def tokens(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))


@pytest.mark.parametrize("n", [513, 700, 1024, 1025, 5000])
def test_wide_bitmaps_keep_every_link(n):
    rng = np.random.default_rng(n)
    a = tokens(rng, n)
    for share in (0.76, 0.8, 0.86, 0.95, 1.0):
        kept = a[:int(len(a) * share)]
        for b in (kept, np.union1d(kept, tokens(rng, n - len(kept) or 1))):
            both = len(np.intersect1d(a, b))
            x, y = tree.wide_signature(a), tree.wide_signature(b)
            if y is not None and 100 * both >= 75 * (len(a) + len(b) - both):
                assert tree.wide_may_link(x, len(a), y, len(b), 75)
                assert tree.wide_may_link(y, len(b), x, len(a), 75)


def test_wide_bitmaps_tell_unlike_sets_apart():
    rng = np.random.default_rng(1)
    a, b = tokens(rng, 3000), tokens(rng, 2500)
    assert not tree.wide_may_link(tree.wide_signature(a), len(a), tree.wide_signature(b), len(b), 75)


def test_small_sets_need_no_wide_bitmap():
    assert tree.wide_signature(tokens(np.random.default_rng(2), 512)) is None
    assert tree.wide_signature(np.empty(0, dtype=np.uint64)) is None
