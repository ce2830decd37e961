"""Connected components of link tables, by label propagation with pointer jumping; nothing goes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """links (a, b) -> node, root: the smallest node that each linked node reaches. Nodes without links have no row.

    A round hooks every tree to the smallest root among its neighbours and halves paths (alternating large-star and
    small-star); rounds grow with the logarithm of the longest chain. The aggregates combine before they shuffle, so a node
    with very many links is no hot key.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # large star: neighbours above a node go to the least of its neighbourhood
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written tables, so that both sides of a join are dealt out by it alone and a node with very many links can be split
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        # small star: neighbours below a node, and itself, go to the least of them
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = materialize(small, "edges")
        stars = new.count() == edges.count() and new.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = new
        if stars:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "roots")
