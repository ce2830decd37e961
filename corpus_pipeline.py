"""The corpus pipeline: documents -> token sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame and works on all rows that the stage before it kept; run()
writes each stage's rows to the shared scratch folder and reads them again. All stages but the last return the columns of
`documents`; those that a stage doesn't need may have any names, as they are put aside under other ones.

Odd inputs, the same in every stage: null and empty texts are never toxic, no one's copy, have no passages, come once and
are packed as one end id; rows that repeat an id and a text are one document from the second stage on; texts of any length
are taken whole; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import aside, distilled, materialize, restored
from gridloom.llm.mixing import mix_sources
from gridloom.llm.ngram_join import ngram_jaccard
from gridloom.llm.packing import pack_documents
from gridloom.llm.queries import BYTE_BPE, vocabulary
from gridloom.llm.suffix_dedup import remove_repeats
from gridloom.llm.toxicity import labelled, score, train

#: A removed-id list of up to this many rows is broadcast; a longer one is a shuffled join.
FEW_IDS = 2_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity score of one half or more; the model learns from this stage's own input."""
    inner, names = aside(docs, ["doc_id", "text"])
    model = train(labelled(inner, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score(inner, model, inner.columns).where("predicted = 0").select(*restored(names))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies: the one with the smallest id, null first, then by the text's hash; rows that repeat an id and a text are one document."""
    # a row goes by a hash of its id and text, so texts are read where they lie: neither written again nor shuffled, but those of repeated rows
    inner, names = aside(docs, ["doc_id", "text"])
    inner = inner.withColumn("_row", F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.col("text").isNull()))
    rows = materialize(inner.groupBy("_row").agg(F.min(F.struct("doc_id", F.xxhash64("text").alias("h"), "_row")).alias("place"), F.count("*").alias("n")), "rows")

    def copies() -> DataFrame:
        classes = ngram_jaccard(inner.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id").distinct()
        placed = materialize(classes.join(rows, "_row").select("_row", "place", "component_id"), "placed")
        first = placed.groupBy("component_id").agg(F.min("place").alias("first"))  # a null id is the least
        return placed.join(first, "component_id").where("_row <> first._row").select(F.col("_row").alias("_gone"))

    gone = distilled(spark, copies, "gone")
    few = lambda ids: F.broadcast(ids) if ids.count() <= FEW_IDS else ids
    kept = inner.join(few(gone), F.col("_row") == F.col("_gone"), "left_anti")
    again = rows.where("n > 1").select(F.col("_row").alias("_again"))
    if not again.isEmpty():
        once, twice = (kept.join(few(again), F.col("_row") == F.col("_again"), how) for how in ("left_anti", "left_semi"))
        kept = once.unionByName(twice.dropDuplicates(["doc_id", "text"]))
    return kept.select(*restored(names))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings of 100 that occur earlier in the corpus; a document that loses all its text stays as an empty one."""
    inner, names = aside(docs, ["doc_id", "text"])
    cut = remove_repeats(inner)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return cut.select(*[(changed[c] if c in changed else F.col(now)).alias(c) for c, now in names.items()])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Temperature mixing that keeps every document and repeats small sources up to 1.25 times."""
    inner, names = aside(docs, ["doc_id", "text", "source"])
    mixed = mix_sources(inner, limit=1.25)
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*restored(names))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return pack_documents(docs.select("doc_id", "text"), vocabulary(BYTE_BPE))


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("repeated_passages", drop_repeated_passages), ("mixing", mix), ("packing", pack)]
#: Tokenizers, suffix order and a trained grammar are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
