"""Ground classes of map cells from imagery, land cover and mapped areas: a table of rules, a least size per class, holes in paving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import focal, graph, rasters

# Limits of the facts below, land-cover codes, least cells of a patch, limits of a hole.
LIMIT = {"bare index": 0.12, "green index": 0.3, "soil index": 0.08, "neutral chroma": 22, "pale": 140, "shade": 90, "red over green": 6, "red over blue": 18}
COVER = {"grassland": 30, "crops": 40, "wetland": 90}
LEAST_CELLS = {"concrete": 3, "asphalt": 12, "soil": 16, "field": 64, "prairie": 64, "marsh": 16, "mud": 16}
HOLE_CELLS, HOLE_GAP = 128, 0.2
PAVING = ["concrete", "asphalt"]

#: class, facts that must hold, facts that must not; where several rules hold, the lowest of the table counts.
RULES = [
    ("concrete", "paved_look pale", ""),
    ("asphalt", "paved_look", "pale"),
    ("soil", "earth", ""),
    ("asphalt", "parking visible", "green"),
    ("field", "crops visible", "bare parking"),
    ("prairie", "grassland green", "parking"),
    ("marsh", "wet green", ""),
    ("mud", "wet earth", ""),
]


def classified(cells: DataFrame) -> DataFrame:
    """cells (red, green, blue, nir, visible, cover, parking, wetland, editable, ...) -> with class; keep where no rule holds or the cell may not be edited.

    Cells that are shaded, invalid or without an index are not visible; null is false. Each fact is a column, worked out once.
    """
    index, light = rasters.ndvi(F.col("red"), F.col("nir")), (F.col("red") + F.col("green") + F.col("blue")) / 3.0
    measured = cells.withColumns({"_index": index, "_light": light, "_chroma": F.greatest("red", "green", "blue") - F.least("red", "green", "blue")})
    at_most = lambda name: F.col("_index") <= LIMIT[name]
    stages = [
        {"visible": F.col("visible") & F.col("_index").isNotNull()},
        {"sunlit": F.col("_visible") & (F.col("_light") >= LIMIT["shade"]), "bare": F.col("_visible") & at_most("bare index"), "green": F.col("_visible") & ~at_most("green index")},
        {"paved_look": F.col("_bare") & F.col("_sunlit") & (F.col("_chroma") < LIMIT["neutral chroma"]), "pale": F.col("_light") >= LIMIT["pale"]},
        {"earth": F.col("_sunlit") & at_most("soil index") & ~F.col("_paved_look") & (F.col("red") - F.col("green") > LIMIT["red over green"]) & (F.col("red") - F.col("blue") > LIMIT["red over blue"])},
        {"wet": F.coalesce(F.col("cover") == COVER["wetland"], F.lit(False)) | F.coalesce("wetland", F.lit(False)), "parking": F.col("parking"), **{c: F.col("cover") == COVER[c] for c in ("crops", "grassland")}},
    ]
    for stage in stages:
        measured = measured.withColumns({f"_{name}": F.coalesce(fact, F.lit(False)) for name, fact in stage.items()})
    met = []
    for place, (name, needs, bars) in enumerate(RULES):
        holds = F.lit(True)
        for fact in needs.split():
            holds = holds & F.col(f"_{fact}")
        for fact in bars.split():
            holds = holds & ~F.col(f"_{fact}")
        met.append(F.when(holds, F.lit(place)))
    lowest = F.greatest(*met)
    names = F.array(*(F.lit(r[0]) for r in RULES))
    found = measured.withColumn("_rule", F.when(F.coalesce("editable", F.lit(False)), lowest))
    return found.withColumn("class", F.coalesce(F.get(names, F.col("_rule")), F.lit("keep"))).select(*cells.columns, "class")


def patches(cells: DataFrame, span: int = 1 << 20) -> DataFrame:
    """cells (x, z, class; |x|, |z| below span / 2) -> x, z, class, label: connected cells of one class, over the four sides."""
    names = [r[0] for r in cells.select("class").distinct().orderBy("class").collect()]
    code = F.array_position(F.array(*map(F.lit, names)), F.col("class")) if names else F.lit(0)
    moved = cells.select((F.col("x") + code * span).alias("x"), "z", F.col("x").alias("own"), "class")
    return moved.join(graph.cell_components(moved, rasters.SIDES, 1 << 24), ["x", "z"]).select(F.col("own").alias("x"), "z", "class", "label")


def without_specks(cells: DataFrame, least: dict[str, int] | None = None) -> DataFrame:
    """cells (x, z, class, ...) with patches below their class's least size set to keep."""
    least, cells = LEAST_CELLS if least is None else least, graph.checkpointed(cells)  # read twice, and its rules are long
    parts = graph.checkpointed(patches(cells.where(F.col("class").isin(*least)).select("x", "z", "class")))
    limit = F.create_map(*[F.lit(v) for pair in least.items() for v in pair])
    small = parts.groupBy("label", "class").agg(F.count("*").alias("n")).where(F.col("n") < limit[F.col("class")]).select("label")
    specks = parts.join(small, "label", "left_semi").select("x", "z", F.lit(True).alias("speck"))
    return cells.join(specks, ["x", "z"], "left").withColumn("class", F.when(F.col("speck"), "keep").otherwise(F.col("class"))).drop("speck")


def without_holes(cells: DataFrame, tile: int, most: int = HOLE_CELLS, gap: float = HOLE_GAP, reach: int = 16) -> DataFrame:
    """cells (x, z, class, index, sunlit, visible, editable) with small unkept holes in paving given the class of the nearest paving.

    A hole is a connected patch of keep cells inside an area that paving and uneditable cells enclose: none of its area's
    cells has a side without a cell. It is filled when it has fewer than `most` cells, its median index lies `gap` below that
    of its tile's lawn (visible editable keep cells outside holes) and more than half of it is sunlit. Paving is looked for
    within `reach` cells, ties to the least z, then x. Tiles without lawn fill nothing.
    """
    open_ground = cells.where(~F.col("class").isin(*PAVING) & F.col("editable")).select("x", "z")
    area = graph.checkpointed(graph.cell_components(open_ground, rasters.SIDES))
    sides = rasters.neighbours(cells.select("x", "z"), rasters.SIDES, []).groupBy("x", "z").agg(F.count("*").alias("sides"))
    outer = area.join(sides, ["x", "z"], "left").where("coalesce(sides, 0) < 4").select("label").distinct()
    inside = area.join(outer, "label", "left_anti").select("x", "z")
    keeps = cells.where((F.col("class") == "keep") & F.col("editable"))
    holes = graph.checkpointed(graph.cell_components(keeps.join(inside, ["x", "z"], "left_semi").select("x", "z"), rasters.SIDES))
    in_tile = [F.floor(F.col(c) / tile).alias(f"t{c}") for c in "xz"]
    lawn = keeps.where("visible").join(holes, ["x", "z"], "left_anti").groupBy(*in_tile).agg(F.expr("percentile(index, 0.5)").alias("lawn"))
    judged = holes.join(cells.select("x", "z", "index", "sunlit"), ["x", "z"]).groupBy("label").agg(F.count("*").alias("n"), F.expr("percentile(index, 0.5)").alias("middle"), F.avg(F.col("sunlit").cast("int")).alias("lit"), F.min(F.struct("z", "x")).alias("first"))
    judged = judged.select("label", "n", "middle", "lit", F.floor(F.col("first.x") / tile).alias("tx"), F.floor(F.col("first.z") / tile).alias("tz")).join(lawn, ["tx", "tz"])
    chosen = judged.where((F.col("n") < most) & (F.col("middle") < F.col("lawn") - gap) & (F.col("lit") > 0.5)).select("label")
    target = graph.checkpointed(holes.join(chosen, "label", "left_semi").select("x", "z", F.lit(True).alias("target")))
    code = F.array_position(F.array(*map(F.lit, PAVING)), F.col("class")).cast("double")
    known = cells.join(target, ["x", "z"], "left").select("x", "z", F.when(F.col("class").isin(*PAVING), code).alias("code"))
    near = focal.tiled(known, "code", max(tile, reach), reach, focal.nearest_value(reach), "code").where("code IS NOT NULL")
    paved = target.join(near, ["x", "z"]).select("x", "z", F.element_at(F.array(*map(F.lit, PAVING)), F.col("code").cast("int")).alias("paved"))
    return cells.join(paved, ["x", "z"], "left").withColumn("class", F.coalesce("paved", "class")).drop("paved")
