"""The pipeline's stages on a small table: what goes, what stays, and the final sequences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tests.llm.test_small import prose  # noqa: E402


def test_stages(spark, tmp_path):
    bad = ["gronk", "blarg", "snirt"]
    rows, labels = [], []
    for i in range(300):
        w = prose(i, 60).split()
        if i % 5 == 0:
            w[10:10], w[30:30] = [bad[i % 3]], ["you", bad[(i + 1) % 3]]
        rows.append((i, " ".join(w), "en", f"s{i % 4}", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    clean = [r for r in rows if r[0] % 5]
    rows += [(500, clean[3][1], "en", "s0", 0), (501, clean[4][1] + " end", "en", "s1", 0), (502, prose(900, 40) + " " + clean[7][1], "en", "s1", 0), (503, None, "en", None, 0), (503, None, "en", None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    ids = lambda name: sorted(i for i, _ in kept[name])
    assert ids("toxicity") == sorted([i for i, *_ in rows if i >= 500 or i % 5])
    assert set(ids("toxicity")) - set(ids("near_copies")) == {500, 501}
    text = dict(kept["repeated_passages"])
    assert clean[7][1] not in text[502] and text[502].startswith(prose(900, 40)[:50])
    assert set(ids("mixing")) == set(ids("repeated_passages"))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert np.isin([r.doc_id for r in packed], ids("mixing")).all() and len({(r.doc_id) for r in packed}) == len(set(ids("mixing")))


#: Names that operators use for results or within: all may stand in the input.
CLASHES = ["n_tokens", "copies", "score", "predicted", "d", "t", "ld", "spans", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "_h", "_b", "_n", "_s", "_row", "_gone", "_own0", "_text", "component_id", "a.b"]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_with_clashing_names_long_texts_and_no_rows(spark, tmp_path, empty):
    rows = [(1, prose(51, 60), "s0", 1), (2, prose(52, 30000), "s1", 2), (3, None, None, 3), (4, "", "s0", 4), (4, "", "s0", 4), (None, prose(53, 60), "s1", None), (6, prose(51, 60), "s0", 6)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, source string, n_chars long")
    for i, c in enumerate(CLASHES):
        docs = docs.withColumn(c, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns, name
        for r in docs.collect():
            assert [r[c] for c in CLASHES] == [f"{i}-{'none' if r.doc_id is None else r.doc_id}" for i in range(len(CLASHES))], name
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts == ({} if empty else {1: rows[0][1], 2: rows[1][1], 3: texts.get(3), 4: "", None: rows[5][1]})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(texts)


def test_near_copies_of_ids_with_several_texts(spark):
    base = prose(31, 80)
    rows = [(1, base), (5, base + " end"), (5, prose(32, 80)), (None, prose(33, 80)), (None, prose(33, 80) + " end"), (7, prose(33, 80) + " stop"), (8, None), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, df, "").collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "5", "8", "None"]
    assert [r.text for r in got if r.doc_id == 5] == [rows[2][1]]
