"""What a worker holds at once: bounded however much its task reads."""

import tracemalloc

import numpy as np
import pyarrow as pa

from gridloom.llm.suffix_dedup import _bundles, _survey, remove_repeats


def test_bundles_of_many_small_anchors_are_ordered_in_small_pieces():
    """9 MB of contexts in groups of ten equal ones: every later one is found, and far less than the arrays of a megabyte of text is held."""
    rng = np.random.default_rng(3)
    texts = [x.tobytes() for x in rng.integers(97, 123, (6000, 160), np.uint8)]
    n = 60_000

    def batches():
        for at in range(0, n, 2000):
            i = np.arange(at, at + 2000)
            zero = pa.array(np.zeros(2000, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(i // 10), pa.array(i), zero, pa.array([texts[j // 10] for j in i], pa.binary()), zero], names=["key", "d", "s", "context", "t"])

    run = _bundles(100)
    found = [0] * n
    tracemalloc.start()
    try:
        for out in run(batches()):
            for d, s, e in zip(*(out.column(i).to_pylist() for i in (0, 2, 3))):
                assert (s, e) == (0, 160)
                found[d] += 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == [int(i % 10 > 0) for i in range(n)]
    assert peak < 90 << 20, peak


def test_an_anchor_with_many_contexts_in_few_documents_is_known_as_frequent(spark):
    """A line that a document repeats between other texts has a context at each place; its bundle would grow with them."""
    rng = np.random.default_rng(4)
    word = lambda n: rng.integers(97, 123, n, np.uint8).tobytes().decode()
    line = word(100)
    rows = [(d, "".join(word(150) + line for _ in range(60))) for d in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _survey(docs, 100, 40)[1].groupBy("key").sum("n").where("`sum(n)` >= 60").count() > 0
    seen: set[str] = set()
    want = {}
    for d, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 99):
            if text[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(text[i : i + 100])
        want[d] = int(gone.sum())
    assert want[0] >= 5900 and want[1] >= 6000
    for often in (2048, 20):
        assert {r.doc_id: r.n_removed for r in remove_repeats(docs, often=often).collect()} == want
