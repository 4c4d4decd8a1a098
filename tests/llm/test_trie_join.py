import random

import numpy as np

from captionlake.llm import simhash


def test_remembered_words_give_the_plain_fingerprints():
    rng, seeds = random.Random(1), (42, 43, 44, 45, 46)
    marked = simhash.WordFingerprints(seeds)
    for n in (0, 1, 5, 300, 70_000, 100_000):  # the last ones fill the memory
        text = " ".join(rng.choice(["a" * rng.randint(1, 50), str(rng.randint(0, 10**9))]) for _ in range(n))
        assert marked(text).tolist() == [simhash.word_fingerprint(text, s) for s in seeds], n
    assert marked(None).tolist() == [0] * 5


def test_trie_pairs_are_all_pairs_within_the_budget():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    near = [values[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) for _ in range(6)]
    values = np.unique(np.concatenate([values, *near]))
    zero, end = np.array([0]), np.array([len(values)])
    got = [p for i, j in simhash.trie_pairs(values, zero, end, zero, end, 0, np.array([3]), 3) for p in zip(i.tolist(), j.tolist())]
    a, b = np.where(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3, 1))
    assert len(got) == len(set(got)) and set(got) == set(zip(a.tolist(), b.tolist()))
