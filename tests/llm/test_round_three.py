"""Pairs of groups that lie in several components: few rows met, no link lost."""

import random

from gridloom.llm import ngram_join


def test_pairs_are_met_at_few_keys_and_none_is_lost(spark):
    """40 classes that share keys at random: what may link by all shared keys is found, from fewer rows than all pairs at all keys."""
    rng = random.Random(5)
    n = {c: rng.randint(30, 44) for c in range(40)}
    keys = {c: set(rng.sample(range(24), n[c] - -(-n[c] * 75 // 100) + 1)) for c in n}
    size = {k: sum(k in v for v in keys.values()) for k in range(24)}
    rows = [(k, c, n[c], c // 2, size[k]) for c in n for k in keys[c]]
    small = spark.createDataFrame(rows, "key long, class long, n long, root long, m long")
    listed_pairs = [(0, 39, n[0], n[39], 3), (50, 51, 30, 30, 5)]
    listed = spark.createDataFrame(listed_pairs, "a long, b long, na long, nb long, c long")
    more = {(a, b): c for a, b, _, _, c in listed_pairs}

    def least(x: int, y: int) -> int:
        return -(-75 * (x + y) // 175) - (-(-75 * max(x, y) // 100) - 1)

    want = set()
    for a in n:
        for b in range(a + 1, 40):
            shared = len(keys[a] & keys[b]) + more.get((a, b), 0)
            if a // 2 != b // 2 and 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b]) and shared and shared >= least(n[a], n[b]):
                want.add((a, b, n[a], n[b]))
    want.add((50, 51, 30, 30))
    found = ngram_join._across(small, listed, 75)
    assert sorted(map(tuple, found.select("a", "b", "na", "nb").collect())) == sorted(want) and len(want) > 50
