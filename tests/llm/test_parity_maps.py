"""Pairs ruled out by parity maps before their sets are met: many, and no link among them."""

import numpy as np

from gridloom.llm import ngram_join


def test_maps_rule_out_far_pairs_and_keep_every_link(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 240, dtype=np.uint64)
    sets = []
    for i in range(40):  # half keep 225 of the base (links of each other), half 120 with 120 of their own
        own = rng.integers(0, 2**63, 15 if i < 20 else 120, dtype=np.uint64)
        sets.append(np.unique(np.concatenate([rng.permutation(base)[: 240 - len(own)], own])))
    sets += [np.arange(3, dtype=np.uint64), np.arange(4, dtype=np.uint64), np.zeros(1, np.uint64)]
    wholes = spark.createDataFrame([(c, bytearray(s.tobytes())) for c, s in enumerate(sets)], "class long, grams binary")
    levels = spark.sparkContext.broadcast(np.zeros(1 << ngram_join.SKETCH, np.uint8))
    parts = ngram_join._cut(wholes, levels)
    n = len(sets)
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for a in range(n) for b in range(a + 1, n)], "a long, b long, na long, nb long")
    shared = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    links = {(a, b) for a in range(n) for b in range(a + 1, n) if 100 * shared(a, b) >= 75 * (len(sets[a]) + len(sets[b]) - shared(a, b))}
    left = {(r.a, r.b) for r in ngram_join._screen(pairs, parts, 75).collect()}
    assert len(links) > 150 and links <= left and len(left) < len(links) + 30
    assert {(r.a, r.b) for r in ngram_join._count(pairs, parts, 75, 1 << 20).collect()} == links
