"""What a stage leaves in shared scratch."""

from pyspark.sql import functions as F


def test_near_copies_stage_leaves_only_what_is_read_later(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from gridloom.llm import common

    monkeypatch.setattr(common, "scratch", lambda _, name: f"file://{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}")
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "other words"), (None, None)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3]
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"rows", "gone"}
    before = {p.name for p in tmp_path.iterdir()}
    cut = corpus_pipeline.drop_repeated_passages(spark, docs.withColumn("n_chars", F.length("text")), "")
    assert cut.count() == 4
    assert {p.name.split("-")[0] for p in tmp_path.iterdir() if p.name not in before} == {"spans"}
