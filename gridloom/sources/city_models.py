"""City-model sequences: JSON lines, a header with the transform and then one feature a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = (
    "type string, id string, transform struct<scale: array<double>, translate: array<double>>, metadata struct<referenceSystem: string>, vertices array<array<double>>, "
    "CityObjects map<string, struct<geometry: array<struct<type: string, lod: string, boundaries: string, semantics: struct<surfaces: array<struct<type: string>>, values: string>>>>>"
)
#: shells, faces, rings, vertex numbers
_SOLID = "array<array<array<array<int>>>>"


def _numbers(values: Column, n: int) -> Column:
    """Whether an array has n finite numbers."""
    return F.coalesce((F.size(values) == n) & F.forall(values, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))), F.lit(False))


def roofs(spark: SparkSession, path: str, crs: str, west: float = 0.0, north: float = 0.0) -> DataFrame:
    """path, feature, face, rings (closed, of struct<x, y, z>: east of west, up, south of north), tolerance, fault.

    A feature's faces are those marked RoofSurface in its one LoD 2.2 Solid. Features without exactly one such solid, with a
    header that is missing, doubled, of another reference system or without a transform, with faulty vertices or semantics,
    or repeated in a file give one row with a fault and no face; so do lines that are no JSON. Blank lines are passed by.
    Lines are split freely over tasks; the header is one small row a file, joined by path.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value")).where("trim(value) <> ''")
    rows = lines.select("path", F.from_json("value", _LINE).alias("j")).select("path", "j.*")
    head = F.struct("transform", F.col("metadata.referenceSystem").alias("crs"))
    heads = rows.where("type = 'CityJSON'").groupBy("path").agg(F.count("*").alias("heads"), F.first(head).alias("head"))
    features = rows.where("type IS NULL OR type = 'CityJSONFeature'").join(heads, "path", "left")
    scale, move = F.col("head.transform.scale"), F.col("head.transform.translate")
    solids = F.filter(F.flatten(F.transform(F.map_values("CityObjects"), lambda o: F.coalesce(o["geometry"], F.array()))), lambda g: (g["type"] == "Solid") & (g["lod"] == "2.2"))
    opened = F.transform(solids, lambda g: F.struct(F.from_json(g["boundaries"], _SOLID).alias("shells"), F.transform(g["semantics"]["surfaces"], lambda s: s["type"]).alias("names"), F.from_json(g["semantics"]["values"], "array<array<int>>").alias("values")))
    found = features.withColumn("s", opened)
    roofed = F.filter("s", lambda g: F.exists(F.flatten(g["values"]), lambda v: F.get(g["names"], v) == "RoofSurface"))
    tagged = lambda g: F.coalesce((F.size(g["shells"]) == 1) & (F.size(g["values"]) == 1) & (F.size(g["shells"][0]) == F.size(g["values"][0])) & F.forall(g["values"][0], lambda v: F.coalesce((v >= 0) & (v < F.size(g["names"])), F.lit(False))), F.lit(False))
    fault = (
        F.when(F.col("type").isNull(), "no feature")
        .when(F.coalesce(F.col("heads"), F.lit(0)) != 1, "header")
        .when(F.col("head.crs") != crs, "reference system")
        .when(~_numbers(scale, 3) | ~_numbers(move, 3) | F.exists(scale, lambda v: v <= 0), "transform")
        .when(F.coalesce(~F.forall("vertices", lambda v: _numbers(v, 3)), F.lit(True)), "vertices")
        .when(~F.forall("s", tagged), "semantics")
        .when(F.coalesce(F.size(roofed), F.lit(0)) != 1, "solids")
    )
    judged = found.select("path", "id", "vertices", "head", fault.alias("fault"), F.get(roofed, F.lit(0)).alias("solid"))
    # an id that a file repeats is ambiguous; ids and counts only
    twice = judged.where("id IS NOT NULL").groupBy("path", "id").agg(F.count("*").alias("n")).where("n > 1").select("path", "id", F.lit("repeated").alias("again"))
    judged = judged.join(twice, ["path", "id"], "left").withColumn("fault", F.coalesce("fault", "again"))
    # rings of one feature: faces with their names, numbers looked up and the ring closed
    at = lambda v, i: v[i] * F.col("head.transform.scale")[i] + F.col("head.transform.translate")[i]
    corner = lambda i: F.transform(F.array(F.get(F.col("vertices"), i)), lambda v: F.struct((at(v, 0) - west).alias("x"), at(v, 2).alias("y"), (F.lit(north) - at(v, 1)).alias("z")))[0]
    ring = lambda r: F.transform(F.when(F.size(r) > 0, F.concat(r, F.slice(r, 1, 1))).otherwise(r), corner)
    faces = judged.select("path", F.col("id").alias("feature"), "vertices", "head", "fault", F.when(F.col("fault").isNull(), F.array_max("head.transform.scale")).alias("tolerance"), F.posexplode_outer(F.when(F.col("fault").isNull(), F.arrays_zip(F.col("solid.shells")[0].alias("rings"), F.transform(F.col("solid.values")[0], lambda v: F.col("solid.names")[v]).alias("name")))).alias("face", "f"))
    kept = faces.where("fault IS NOT NULL OR f.name = 'RoofSurface'")
    missing = F.exists("f.rings", lambda r: F.exists(r, lambda i: F.coalesce((i < 0) | (i >= F.size("vertices")), F.lit(True))))
    return kept.select("path", "feature", "face", F.when(F.col("fault").isNull() & ~missing, F.transform("f.rings", ring)).alias("rings"), "tolerance", F.coalesce("fault", F.when(missing, "vertex number")).alias("fault"))
