"""Polygons as arrays of rings; a ring is an array of struct<x, z>. Even-odd rule over all edges, so holes and XOR-ed rings work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box_ring(x0: Column, z0: Column, x1: Column, z1: Column) -> Column:
    p = lambda x, z: F.struct(x.cast("double").alias("x"), z.cast("double").alias("z"))
    return F.array(p(x0, z0), p(x1, z0), p(x1, z1), p(x0, z1), p(x0, z0))


def edges(rings: Column) -> Column:
    """All edges of the rings: struct<ax, az, bx, bz>."""
    each = lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(r[i - 1]["x"].alias("ax"), r[i - 1]["z"].alias("az"), r[i]["x"].alias("bx"), r[i]["z"].alias("bz")))
    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 1), each))


def inside(rings: Column, x: Column, z: Column) -> Column:
    """Whether (x, z) lies inside by the even-odd rule; the lower and left edges belong to the polygon."""
    crossed = F.aggregate(edges(rings), F.lit(False), lambda s, e: s != (((e["az"] > z) != (e["bz"] > z)) & (x < e["ax"] + (z - e["az"]) * (e["bx"] - e["ax"]) / F.when(e["bz"] != e["az"], e["bz"] - e["az"]))))
    return F.coalesce(crossed, F.lit(False))


def ring_distance2(rings: Column, x: Column, z: Column) -> Column:
    """Squared distance to the nearest edge."""

    def one(e: Column) -> Column:
        dx, dz = e["bx"] - e["ax"], e["bz"] - e["az"]
        length = dx * dx + dz * dz
        t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["ax"]) * dx + (z - e["az"]) * dz) / length))).otherwise(0.0)
        return F.pow(x - e["ax"] - t * dx, 2) + F.pow(z - e["az"] - t * dz, 2)

    return F.array_min(F.transform(edges(rings), one))


def area(ring: Column) -> Column:
    """Shoelace area of a closed ring."""
    doubled = F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0.0), lambda s, i: s + ring[i - 1]["x"] * ring[i]["z"] - ring[i]["x"] * ring[i - 1]["z"])
    return F.abs(doubled) / 2


def rasterise(shapes: DataFrame, *keys: str, rings: str = "rings") -> DataFrame:
    """keys, x, z of the unit cells whose centre is inside; shapes have box columns x0, z0, x1, z1.

    Row by row: of the sorted crossings of a row of centres with the edges each second one opens a span, so a cell costs no
    test of its own. The lower and left edges belong to the polygon, as in `inside`.
    """
    rows = shapes.withColumn("_e", edges(F.col(rings))).select(*keys, "x0", "x1", "_e", F.explode(F.sequence(F.floor("z0").cast("long"), F.ceil("z1").cast("long") - 1)).alias("z"))
    at = F.col("z") + 0.5
    cut = F.filter("_e", lambda e: (e["az"] > at) != (e["bz"] > at))
    rows = rows.withColumn("_c", F.array_sort(F.transform(cut, lambda e: e["ax"] + (at - e["az"]) * (e["bx"] - e["ax"]) / (e["bz"] - e["az"]))))
    low, high = F.floor("x0").cast("long"), F.ceil("x1").cast("long") - 1
    span = lambda i: F.struct(F.greatest(F.ceil(F.get("_c", i) - 0.5).cast("long"), low).alias("a"), F.least(F.ceil(F.get("_c", i + 1) - 0.5).cast("long") - 1, high).alias("b"))
    spans = F.transform(F.sequence(F.lit(0), F.size("_c") - 1, F.lit(2)), span)
    rows = rows.where(F.size("_c") > 1).withColumn("_s", F.explode(F.filter(spans, lambda s: s["a"] <= s["b"])))
    return rows.select(*keys, F.explode(F.sequence(F.col("_s.a"), F.col("_s.b"))).alias("x"), "z")


def row_spans(found: Column, at: Column) -> Column:
    """array(struct<a, b>) of the cells of one row of centres that lie within the edges or on one; spans may overlap."""
    cut = F.filter(found, lambda e: (e["az"] > at) != (e["bz"] > at))
    crossed = F.array_sort(F.transform(cut, lambda e: e["ax"] + (at - e["az"]) * (e["bx"] - e["ax"]) / (e["bz"] - e["az"])))
    span = lambda a, b: F.struct(F.ceil(a - 0.5).cast("long").alias("a"), F.floor(b - 0.5).cast("long").alias("b"))
    pairs = lambda c: F.transform(F.filter(F.transform(c, lambda v, i: F.struct(v.alias("c"), i.alias("i"))), lambda s: s["i"] % 2 == 0), lambda s: span(s["c"], F.get(c, s["i"] + 1)))
    inner = F.flatten(F.transform(F.array(crossed), pairs))  # as a lambda's argument the crossings are found once
    touched = F.transform(F.filter(found, lambda e: e["az"] == at), lambda e: F.when(e["bz"] == at, span(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))).otherwise(span(e["ax"], e["ax"])))
    return F.filter(F.concat(inner, touched), lambda s: s["a"] <= s["b"])


def scan_cells(shapes: DataFrame, rings: str = "rings") -> DataFrame:
    """The shapes' other columns with x, z of the unit cells whose centre lies inside or on an edge; a cell may come twice.

    Row by row: the sorted crossings of a row of centres with the edges give the inner spans, so a cell costs no test of its own.
    Edges and corners that lie on the row are spans too. Shapes without a ring have no cells.
    """
    found = shapes.withColumn("_e", edges(F.col(rings))).drop(rings).where(F.size("_e") > 0)
    bound = lambda pick: pick(F.transform("_e", lambda e: e["az"]))
    rows = found.withColumn("z", F.explode(F.sequence(F.floor(bound(F.array_min)).cast("long"), F.floor(bound(F.array_max)).cast("long"))))
    spans = rows.withColumn("_s", F.explode(row_spans(F.col("_e"), F.col("z") + 0.5))).drop("_e")
    return spans.withColumn("x", F.explode(F.sequence(F.col("_s.a"), F.col("_s.b")))).drop("_s")


def paint(cells: DataFrame, order: Column, label: str, copies: Column | None = None) -> DataFrame:
    """One label per cell: the one painted last; a row counts as `copies` coats."""
    return cells.groupBy("x", "z").agg(F.max_by(label, order).alias(label), (F.count("*") if copies is None else F.sum(copies)).alias("painted"))


def associate(points: DataFrame, shapes: DataFrame, key: str, ring_width: float = 1.0, bin_size: int = 16, copies: str | None = None) -> DataFrame:
    """Points (x, z, pid) in or within `ring_width` of polygons: pid, key, core, owners (polygons that claim the point).

    copies names the number of equal polygons that a row of shapes stands for; owners counts each of them. Neither side of the
    join is broadcast: a small file of shapes is large once its rows are in bins with their rings.
    """
    from pyspark.sql import Window

    lo = lambda c: F.floor((F.col(c) - ring_width) / bin_size)
    hi = lambda c: F.floor((F.col(c) + ring_width) / bin_size)
    binned = shapes.withColumn("bx", F.explode(F.sequence(lo("x0"), hi("x1")))).withColumn("bz", F.explode(F.sequence(lo("z0"), hi("z1"))))
    at = points.withColumn("bx", F.floor(F.col("x") / bin_size)).withColumn("bz", F.floor(F.col("z") / bin_size))
    near = at.join(binned.hint("merge"), ["bx", "bz"]).where((F.col("x") >= F.col("x0") - ring_width) & (F.col("x") <= F.col("x1") + ring_width) & (F.col("z") >= F.col("z0") - ring_width) & (F.col("z") <= F.col("z1") + ring_width))
    judged = near.withColumn("core", inside(F.col("rings"), F.col("x"), F.col("z")))
    claimed = judged.where(F.col("core") | (ring_distance2(F.col("rings"), F.col("x"), F.col("z")) <= ring_width**2))
    each = F.count("*") if copies is None else F.sum(copies)
    return claimed.withColumn("owners", each.over(Window.partitionBy("pid"))).select("pid", key, "core", "owners")


def assemble_rings(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways (way, nodes array) with all their nodes known and a closed ring: way, ring."""
    refs = ways.select("way", F.size("nodes").alias("n"), F.posexplode("nodes").alias("pos", "node"))
    met = refs.join(nodes, "node").groupBy("way", "n").agg(F.array_sort(F.collect_list(F.struct("pos", "node", "x", "z"))).alias("r"))
    whole = met.where((F.size("r") == F.col("n")) & (F.col("n") >= 4) & (F.col("r")[0]["node"] == F.element_at("r", -1)["node"]))
    return whole.select("way", F.transform("r", lambda p: F.struct(p["x"].cast("double").alias("x"), p["z"].cast("double").alias("z"))).alias("ring"))


def roof_gates(mask: DataFrame, model: DataFrame, provider: DataFrame, key: str, least: float = 0.9, outside: float = 0.1, apart: float = 2.0) -> DataFrame:
    """Whether a roof model agrees with its footprint: key, coverage, outside_share, residual, accepted.

    mask (key, x, z) are footprint cells, model (key, x, z, top) roof cells, one row a cell, provider (key, height) the stated
    maximum; a key's provider rows are judged each, and their other columns follow the key. A
    footprint without a model has coverage 0 and is not accepted, nor is one with a top that is null, not finite or no
    whole number; a model without footprint cells is left out.
    """
    true, none = F.lit(True), F.lit(None)
    both = mask.select(key, "x", "z", true.alias("own"), none.cast("boolean").alias("made"), none.cast("double").alias("top"))
    both = both.unionByName(model.select(key, "x", "z", none.cast("boolean").alias("own"), true.alias("made"), F.col("top").cast("double").alias("top")))
    # dealt by key once: cells and keys are both summed where they are
    cells = both.repartition(key).groupBy(key, "x", "z").agg(F.max("own").alias("own"), F.max("made").alias("made"), F.max("top").alias("top"))
    top = F.when(F.col("own") & F.col("made"), F.col("top").cast("double"))
    odd = F.col("own") & F.col("made") & (F.col("top").isNull() | ~(F.floor(F.col("top").cast("double")) == F.col("top").cast("double")) | F.isnan(F.col("top").cast("double")))
    sums = cells.groupBy(key).agg(F.count("own").alias("n"), F.count("made").alias("m"), F.count_if(F.col("own") & F.col("made")).alias("both"), F.max(top).alias("highest"), F.count_if(odd).alias("odd")).where("n > 0")
    others = [c for c in provider.columns if c not in (key, "height")]
    out = sums.join(provider, key).select(key, *others, (F.col("both") / F.col("n")).alias("coverage"), ((F.col("m") - F.col("both")) / F.greatest(F.col("m"), F.lit(1))).alias("outside_share"), (F.col("highest") - F.col("height")).alias("residual"), "odd")
    good = (F.col("coverage") >= least) & (F.col("outside_share") <= outside) & (F.col("odd") == 0) & (F.abs("residual") <= apart)
    return out.select(key, *others, "coverage", "outside_share", "residual", F.coalesce(good, F.lit(False)).alias("accepted"))


def clip(ring: Column, west: Column, north: Column, east: Column, south: Column) -> Column:
    """An open ring (array of struct<x, z> doubles) cut to the box, half-plane by half-plane: a fold over the four sides.

    What lies on a side stays. Of a ring that is not convex, parts outside shrink to segments on the box's border, which have
    no area. Nothing left: an empty array.
    """
    side = lambda a, b, c: F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), c.cast("double").alias("c"))
    sides = F.array(side(-1.0, 0.0, -west), side(1.0, 0.0, east), side(0.0, -1.0, -north), side(0.0, 1.0, south))
    over = lambda p, h: h["a"] * p["x"] + h["b"] * p["z"] - h["c"]

    def corner(before: Column, now: Column, h: Column) -> Column:
        p, q = over(before, h), over(now, h)
        t = p / F.when(p != q, p - q)
        met = F.struct((before["x"] + t * (now["x"] - before["x"])).alias("x"), (before["z"] + t * (now["z"] - before["z"])).alias("z"))
        return F.when(q <= 0, F.when(p > 0, F.array(met, now)).otherwise(F.array(now))).when(p <= 0, F.array(met)).otherwise(F.array().cast("array<struct<x:double,z:double>>"))

    def cut(r: Column, h: Column) -> Column:
        n = F.size(r)
        each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: corner(F.element_at(r, F.when(i == 0, n).otherwise(i)), F.get(r, i), h))
        return F.when(n > 0, F.flatten(each)).otherwise(r)

    return F.aggregate(sides, ring.cast("array<struct<x:double,z:double>>"), cut)


def open_area(ring: Column) -> Column:
    """Shoelace area of an open ring; 0 for fewer than three corners."""
    return F.when(F.size(ring) > 2, area(F.concat(ring, F.slice(ring, 1, 1)))).otherwise(0.0)


def tile_plan(shapes: DataFrame, key: str, size: int, halo: int = 0) -> DataFrame:
    """shapes (key, ring: open) -> key, tx, tz, area of the part in the tile, halo bounds, offset and priority (near the origin first).

    A ring's tiles are those of its bounding box in which it has an area. Rings with fewer than three corners have none.
    """
    ring = F.col("ring")
    low = lambda c: F.floor(F.array_min(F.transform(ring, lambda p: p[c])) / size)
    high = lambda c: F.ceil(F.array_max(F.transform(ring, lambda p: p[c])) / size) - 1
    span = lambda c: F.explode(F.sequence(low(c), F.greatest(low(c), high(c))))
    tiles = shapes.where(F.size("ring") > 2).withColumn("tx", span("x")).withColumn("tz", span("z"))
    west, north = F.col("tx") * size, F.col("tz") * size
    part = clip(ring, west, north, west + size, north + size)
    cut = tiles.withColumn("area", F.transform(F.array(part), open_area)[0]).where("area > 0")  # as a lambda's argument a ring is cut once
    bounds = F.array(west - halo, north - halo, west + (size + halo), north + (size + halo))
    return cut.select(key, "tx", "tz", "area", bounds.alias("bounds"), F.array(west, north).alias("offset"), (F.pow(F.col("tx") + 0.5, 2) + F.pow(F.col("tz") + 0.5, 2)).alias("priority"))


def supercover(segments: DataFrame, key: str, size: int) -> DataFrame:
    """Segments (key, ax, az, bx, bz: whole numbers) -> key, cx, cz of every cell whose closed square a segment touches, once each.

    Column by column of cells, the segment's extent in a column gives its rows; all comparisons are between whole numbers, so
    a segment through a corner touches all four cells there. A point is a segment of no length. Numbers up to 10^9 are exact.
    """
    s = segments.selectExpr(key, "CASE WHEN ax <= bx THEN ax ELSE bx END AS ax", "CASE WHEN ax <= bx THEN az ELSE bz END AS az", "CASE WHEN ax <= bx THEN bx ELSE ax END AS bx", "CASE WHEN ax <= bx THEN bz ELSE az END AS bz")
    floor = lambda n, d: f"((({n}) - pmod(({n}), ({d}))) div ({d}))"
    columns = s.selectExpr("*", f"explode(sequence({floor('ax - 1', size)}, {floor('bx', size)})) AS cx", "bx - ax AS dx", "bz - az AS dz")
    ends = columns.selectExpr("*", f"greatest(ax, cx * {size}) - ax AS l", f"least(bx, (cx + 1) * {size}) - ax AS r")
    # z at both ends of the column as numerators over dx; a vertical segment has its own ends over 1
    over = ends.selectExpr(key, "cx", "CASE WHEN dx = 0 THEN az ELSE az * dx + l * dz END AS p", "CASE WHEN dx = 0 THEN bz ELSE az * dx + r * dz END AS q", f"CASE WHEN dx = 0 THEN 1 ELSE dx END * {size} AS d")
    rows = over.selectExpr(key, "cx", f"explode(sequence({floor('least(p, q) - 1', 'd')}, {floor('greatest(p, q)', 'd')})) AS cz")
    return rows.distinct()
