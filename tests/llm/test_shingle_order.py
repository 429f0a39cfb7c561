"""The list of common shingles orders shingles only: with any list, sets that are alike share one of their first shingles."""

import numpy as np

from textloom.llm import simhash


def test_alike_sets_share_a_first_shingle_under_any_list():
    rng = np.random.default_rng(4)
    alike = 0
    for _ in range(400):
        n = int(rng.integers(5, 60))
        a = np.unique(rng.integers(0, 1 << 40, n))
        b = a.copy()
        changed = int(rng.integers(0, max(1, len(a) // 8) + 1))
        b[rng.permutation(len(b))[:changed]] = rng.integers(0, 1 << 40, changed)
        b = np.unique(b)
        both = len(np.intersect1d(a, b))
        if both < 0.8 * (len(a) + len(b) - both):
            continue
        alike += 1
        every = np.union1d(a, b)
        for listed in (every[:0], rng.permutation(every), rng.permutation(every)[: len(every) // 2]):
            order = np.argsort(listed)
            ranks = (listed[order], order)
            firsts = [simhash.prefix(s, ranks, 0.8) for s in (a, b)]
            assert len(np.intersect1d(*firsts))
    assert alike > 100
