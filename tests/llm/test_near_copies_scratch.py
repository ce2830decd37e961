"""Near copies are dropped without writing or shuffling the texts."""

import uuid

import corpus_pipeline
from gridloom.llm import common


def test_near_copies_write_no_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch", lambda _, name: f"file://{tmp_path}/{name}-{uuid.uuid4().hex}")
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (4, text + " more"), (None, "alone"), (None, "alone"), (7, None), (7, None), (7, ""), (None, text), (8, "b a c d e f"), (8, "a b c d e f")]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [(None, "alone"), (7, None), (7, ""), (None, text), (8, "b a c d e f"), (8, "a b c d e f")]))
    for left in tmp_path.iterdir():
        assert "text" not in spark.read.parquet(f"file://{left}").columns
