"""Components and greedy selection as bounded rounds of joins; each round is checkpointed to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.rasters import neighbours
from gridloom.sources.shared import shared_folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (id), edges (a, b; both directions) -> id, label: the smallest id of the component.

    Each round takes the least label among neighbours, then follows labels once (labels are ids), so rounds grow with the
    logarithm of a component's diameter rather than with the diameter.
    """
    edges = checkpointed(edges.select("a", "b").distinct())
    labels = checkpointed(nodes.select("id", F.col("id").alias("label")))
    while True:
        near = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("label").alias("m"))
        hooked = labels.join(near, labels.id == near.a, "left").select("id", F.col("label").alias("old"), F.least("label", F.coalesce("m", "label")).alias("label"))
        jump = hooked.select(F.col("id").alias("via"), F.col("label").alias("further"))
        new = checkpointed(hooked.join(jump, hooked.label == jump.via, "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        if new.where("label <> old").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")


def cell_components(cells: DataFrame, offsets: list[tuple[int, int]], span: int = 1 << 24) -> DataFrame:
    """cells (x, z) -> x, z, label: components under the neighbour offsets; labels are cell numbers x * span + z."""
    number = lambda x, z: F.col(x) * span + F.col(z)
    own = cells.select("x", "z").distinct()
    seen = neighbours(own.withColumn("b", number("x", "z")), offsets, ["b"]).join(own, ["x", "z"], "left_semi")
    labels = connected(own.select(number("x", "z").alias("id")), seen.select(number("x", "z").alias("a"), "b"))
    return own.withColumn("id", number("x", "z")).join(labels, "id").select("x", "z", "label")


def around(r: int = 1) -> list[tuple[int, int, int]]:
    """The offsets of a cube without its middle: 26 for r = 1."""
    side = range(-r, r + 1)
    return [(a, b, c) for a in side for b in side for c in side if (a, b, c) != (0, 0, 0)]


def shifted(voxels: DataFrame, offsets: list[tuple[int, int, int]], *columns: str) -> DataFrame:
    """Each voxel (x, y, z) with its columns, once at every offset from it."""
    o = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a, b, c in offsets]))
    return voxels.select("x", "y", "z", o.alias("o"), *columns).select((F.col("x") + F.col("o.a")).alias("x"), (F.col("y") + F.col("o.b")).alias("y"), (F.col("z") + F.col("o.c")).alias("z"), *columns)


def voxel_components(voxels: DataFrame, span: int = 1 << 20) -> DataFrame:
    """voxels (x, y, z below span) -> x, y, z, label: components over the 26 neighbours; a label is the least voxel number."""
    own = voxels.select("x", "y", "z").distinct().withColumn("id", (F.col("x") * span + F.col("z")) * span + F.col("y"))
    seen = shifted(own, around(), "id").withColumnRenamed("id", "b").join(own, ["x", "y", "z"])
    return own.join(connected(own.select("id"), seen.select(F.col("id").alias("a"), "b")), "id").select("x", "y", "z", "label")


def floating(voxels: DataFrame, grounded: DataFrame, owned: DataFrame, most: int = 2000) -> DataFrame:
    """label, cells, low: components of at most `most` voxels that rest on no grounded voxel and touch no owned one.

    voxels, grounded and owned have x, y, z. A component rests on the ground when one of its voxels stands right above a
    grounded voxel; it is attached when one of them is owned or a neighbour of an owned voxel.
    """
    parts = checkpointed(voxel_components(voxels))
    held = grounded.select("x", (F.col("y") + 1).alias("y"), "z").unionByName(shifted(owned, [*around(), (0, 0, 0)])).distinct()
    safe = parts.join(held, ["x", "y", "z"], "left_semi").select("label").distinct()
    return parts.join(safe, "label", "left_anti").groupBy("label").agg(F.count("*").alias("cells"), F.min("y").alias("low")).where(F.col("cells") <= most)


def seeded_pieces(cells: DataFrame, tile: list[str], wanted: Column, unwanted: Column, span: int = 1 << 24) -> DataFrame:
    """tile columns, x, z, cells, land_inside: the four-neighbour pieces of each tile's cells that hold a wanted seed.

    Barriers are the cells that the table lacks; pieces don't cross tiles. x, z is a piece's first cell; land_inside tells
    that an unwanted seed lies in it, which means that the barrier does not part the tile as expected.
    """
    own = cells.select(*tile, "x", "z", wanted.alias("_w"), unwanted.alias("_u"), (F.col("x") * span + F.col("z")).alias("id"))
    seen = neighbours(own.withColumnRenamed("id", "b"), [(1, 0), (-1, 0), (0, 1), (0, -1)], ["b", *tile]).join(own, [*tile, "x", "z"]).select(F.col("id").alias("a"), "b")
    parts = own.join(connected(own.select("id"), seen), "id").groupBy(*tile, "label")
    sums = parts.agg(F.count("*").alias("cells"), F.bool_or("_w").alias("_w"), F.bool_or("_u").alias("land_inside")).where("_w")
    return sums.select(*tile, F.floor(F.col("label") / span).alias("x"), F.pmod("label", F.lit(span)).alias("z"), "cells", "land_inside")


def suppress(items: DataFrame, conflicts: DataFrame, order: list[Column]) -> DataFrame:
    """Greedy selection: in the given order an item stays if no better one that stays conflicts with it.

    items (id, columns), conflicts (a, b). A round keeps every undecided item that has no undecided better neighbour, and
    drops what conflicts with the kept: the result is that of the one-by-one rule.
    """
    ranked = items.withColumn("_o", F.struct(*order, F.col("id")))
    both = conflicts.select("a", "b").unionByName(conflicts.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    o = ranked.select("id", "_o")
    worse = both.join(o.select(F.col("id").alias("a"), F.col("_o").alias("oa")), "a").join(o.select(F.col("id").alias("b"), F.col("_o").alias("ob")), "b")
    better = checkpointed(worse.where("ob < oa").select("a", "b"))  # b comes before a
    open_, kept = checkpointed(items.select("id")), None
    while not open_.isEmpty():
        waits = better.join(open_.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("a").alias("id")).distinct()
        stay = checkpointed(open_.join(waits, "id", "left_anti"))
        kept = stay if kept is None else kept.unionByName(stay)
        gone = better.join(stay.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("a").alias("id")).distinct()
        open_ = checkpointed(open_.join(stay, "id", "left_anti").join(gone, "id", "left_anti"))
    return items if kept is None else items.join(kept, "id", "left_semi")


def reach(start: DataFrame, cells: DataFrame, offsets: list[tuple[int, int]], steps: int) -> DataFrame:
    """x, z, step: the least number of neighbour steps (at most `steps`) from the start cells through `cells`."""
    found = checkpointed(start.select("x", "z").distinct().withColumn("step", F.lit(0)))
    edge = found
    for k in range(1, steps + 1):
        edge = neighbours(edge, offsets, []).select("x", "z").distinct().join(cells, ["x", "z"], "left_semi").join(found, ["x", "z"], "left_anti").withColumn("step", F.lit(k))
        found = checkpointed(found.unionByName(edge))
        edge = found.where(F.col("step") == k)
        if edge.isEmpty():
            break
    return found
