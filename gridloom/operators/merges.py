"""Conditional merges and verification: outcomes are columns, never exceptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_edits(blocks: DataFrame, edits: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One layer of edits (keys, state, expect; a null expect means the cell must be empty) -> (blocks after it, edits with outcome)."""
    judged = edits.join(blocks.withColumnRenamed("state", "current"), keys, "left")
    outcome = F.when(F.col("current").eqNullSafe(F.col("state")), "unchanged").when(F.col("current").eqNullSafe(F.col("expect")), "applied").otherwise("precondition_failed")
    judged = judged.withColumn("outcome", outcome)
    written = judged.where("outcome = 'applied'").select(*keys, "state")
    return blocks.join(written, keys, "left_anti").unionByName(written), judged


def apply_layers(blocks: DataFrame, layers: list[DataFrame], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Layers in order; each sees what those before it wrote."""
    results = []
    for k, layer in enumerate(layers):
        blocks, judged = apply_edits(blocks, layer, keys)
        results.append(judged.withColumn("layer", F.lit(k)))
    return blocks, reduce(DataFrame.unionByName, results)


def insert_missing(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    return existing.unionByName(incoming.join(existing, keys, "left_anti"))


def quality_merge(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """current (key, hash), incoming (key, new_hash, baselines): decision per key."""
    met = current.join(incoming, key, "full_outer")
    decision = F.when(F.col("new_hash").isNull(), "keep").when(F.col("hash").isNull(), "add").when(F.col("hash") == F.col("new_hash"), "same").when(F.array_contains("baselines", F.col("hash")), "upgrade").otherwise("conflict")
    return met.withColumn("decision", decision)


def verify_manifest(listed: DataFrame, found: DataFrame, key: str = "path") -> DataFrame:
    """listed (path, bytes, sha256) against found: status of each listed file."""
    other = found.select(key, F.col("bytes").alias("f_bytes"), F.col("sha256").alias("f_sha256"))
    status = F.when(F.col("f_bytes").isNull(), "missing").when(F.col("f_bytes") != F.col("bytes"), "size_mismatch").when(F.col("f_sha256") != F.col("sha256"), "hash_mismatch").otherwise("ok")
    return listed.join(other, key, "left").withColumn("status", status)


def differences(first: DataFrame, second: DataFrame, key: str, content: str) -> DataFrame:
    """Keys whose content differs or that one side alone has."""
    b = second.select(key, F.col(content).alias("other"))
    met = first.select(key, content).join(b, key, "full_outer").where(~F.col(content).eqNullSafe(F.col("other")))
    return met.withColumn("kind", F.when(F.col("other").isNull(), "first_only").when(F.col(content).isNull(), "second_only").otherwise("changed"))


def ownership_faults(parts: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that are not owned exactly once: owners 0, or above 1, or outside the expected grid."""
    counted = parts.groupBy(*keys).agg(F.count("*").alias("owners"))
    grid = expected.select(*keys, F.lit(True).alias("expected"))
    met = counted.join(grid, keys, "full_outer").select(*keys, F.coalesce("owners", F.lit(0)).cast("long").alias("owners"), F.coalesce("expected", F.lit(False)).alias("expected"))
    return met.where("owners <> 1 OR NOT expected")


def digest(df: DataFrame, keys: list[str], parts: list[Column]) -> DataFrame:
    """An order-independent content hash per key: SHA-256 over the sorted row texts."""
    row = F.concat_ws("|", *[p.cast("string") for p in parts])
    return df.groupBy(*keys).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), "\n"), 256).alias("digest"), F.count("*").alias("rows"))
