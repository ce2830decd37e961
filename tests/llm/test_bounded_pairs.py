"""Scratch of near-copy search: pairs are met in goes, rare n-grams that the sketch hides are no bulk of differences."""

import numpy as np

from gridloom.llm import common, ngram_join


def test_halves_of_a_map_are_the_smaller_map(spark):
    rng = np.random.default_rng(1)
    big = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    wide = ngram_join.parity_map(big)
    assert len(wide) * 64 == 16384 and len(ngram_join.parity_map(big[:500])) * 64 == ngram_join.MAP
    sets = [big, big[:2040], big[:2900], np.concatenate([big[:1500], rng.integers(0, 2**63, 540, dtype=np.uint64)])]
    wholes = spark.createDataFrame([(c, bytearray(np.sort(s).tobytes())) for c, s in enumerate(sets)], "class long, grams binary")
    parts = ngram_join._cut(wholes, spark.sparkContext.broadcast(np.zeros(1 << ngram_join.SKETCH, np.uint8)))
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for a in range(4) for b in range(a + 1, 4)], "a long, b long, na long, nb long")
    left = {(r.a, r.b) for r in ngram_join._screen(pairs, parts, 65).collect()}
    assert left == {(0, 1), (0, 2), (1, 2)}  # before, maps of 2,048 bits ruled out no pair of such sets


def test_goes_meet_each_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: 200 - k], rng.integers(0, 2**63, k, dtype=np.uint64)])) for k in range(30)]
    wholes = spark.createDataFrame([(c, bytearray(s.tobytes())) for c, s in enumerate(sets)], "class long, grams binary")
    parts = ngram_join._cut(wholes, spark.sparkContext.broadcast(np.zeros(1 << ngram_join.SKETCH, np.uint8)))
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for a in range(30) for b in range(a + 1, 30)], "a long, b long, na long, nb long")
    whole = sorted(map(tuple, ngram_join._count(pairs, parts, 75, 1 << 20).collect()))
    made = []
    monkeypatch.setattr(ngram_join, "materialize", lambda df, name: made.append(name) or common.materialize(df, name))
    monkeypatch.setattr(ngram_join, "HELD", 200_000)
    assert sorted(map(tuple, ngram_join._count(pairs, parts, 75, 1 << 20).collect())) == whole and len(whole) > 100
    assert made.count("linked") > 2


def test_texts_that_share_a_passage_are_not_taken_as_differences(spark, monkeypatch):
    """60 texts with nothing in common but one sentence, whose n-grams a coarse sketch doesn't tell from rare ones."""
    seen = []
    kept = ngram_join._differences
    monkeypatch.setattr(ngram_join, "_differences", lambda coded, *a: seen.append(coded.count()) or kept(coded, *a))
    monkeypatch.setattr(ngram_join, "_levels", lambda counts: (np.zeros(1 << ngram_join.SKETCH, np.uint8), 100))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30)) + " this one passage stands in all of the texts") for i in range(60)] + [(60, " ".join(f"w7x{j}" for j in range(30)) + " this one passage stands in all of them")]
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{i: i for i in range(60)}, 60: 7}
    assert seen == [0]


def test_sketch_pieces_survive_packing():
    rng = np.random.default_rng(3)
    for counts in (np.zeros(1 << 14, np.uint32), rng.integers(0, 4, 1 << 14).astype(np.uint32), rng.integers(0, 900, 1 << 14).astype(np.uint32), np.eye(1, 1 << 14, 5, dtype=np.uint32)[0]):
        at, count = ngram_join._pack(counts)
        back = np.zeros(1 << 14, np.uint32)
        if count:
            places, values = ngram_join._unpacked(at, count)
            back[places] += values.astype(np.uint32)
        assert (back == counts).all()
