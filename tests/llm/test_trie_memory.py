"""A large group of near copies is walked in pieces that stay small."""

import tracemalloc

import numpy as np

from tillspark.llm import simhash


def test_near_copies_take_little_memory(monkeypatch):
    rng = np.random.default_rng(7)
    values = np.full(7000, rng.integers(0, 2**63, dtype=np.uint64))
    for _ in range(3):
        values ^= np.uint64(1) << rng.integers(0, 64, len(values)).astype(np.uint64)
    values = np.unique(values)
    tracemalloc.start()
    found = simhash.trie_components(values, np.array([0]), simhash.BUDGET)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 10**9)
    assert (found == simhash.trie_components(values, np.array([0]), simhash.BUDGET)).all()
