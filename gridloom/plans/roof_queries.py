"""City models: written as sequences, read again, planes fitted, heights per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import planes
from gridloom.plans.polygon_queries import _EDGES, _RINGS, rings
from gridloom.plans.registry import query
from gridloom.sources import city_models
from gridloom.sources.shared import scratch

CRS, WEST, NORTH, STEP = "EPSG:32616+5703", 448000.0, 4640000.0, 64
#: Sequences that the features are dealt into.
PARTS = 48
#: What is wrong with a feature, by fid % 16; from 7 on nothing is.
FAULTS = ("vertical", "collinear", "not planar", "crossing", "solids", "vertex number", "empty")


def city_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, part: a feature a footprint (its ring as one sloping face, a second face over its box, a wall) and a header a part."""
    f = rings(spark, sf_dir).withColumns({"k": F.col("fid") % 16, "sx": (F.col("fid") % 5 - 2) / 4, "sz": (F.col("fid") % 7 - 3) / 8, "up": F.col("fid") % 11 + 10 + 1 / 64})
    corner = lambda x, z, y: F.array(*((v * STEP).cast("long") for v in (x - 0.0, -(z - 0.0), y)))
    first = F.transform("ring", lambda p: corner(p["x"], p["z"], F.col("up") + F.col("sx") * (p["x"] - F.col("x0")) + F.col("sz") * (p["z"] - F.col("z0"))))
    lower = lambda x, z: corner(x, z, F.col("up") + 1 - F.col("sx") * (x - F.col("x0")))
    x0, z0, x1, z1 = (F.col(c) for c in ("x0", "z0", "x1", "z1"))
    box = F.array(lower(x0, z0), lower(x1, z0), lower(x1, z1), lower(x0, z1))
    line = F.array(lower(x0, z0), lower(x1, z0), lower((x0 + x1) / 2, z0))
    upright = F.array(corner(x0, z0, F.col("up")), corner(x1, z1, F.col("up")), corner(x1, z1, F.col("up") + 3))
    bent = F.array(lower(x0, z0), lower(x1, z0), lower(x1, z1), corner(x0, z1, F.col("up") + 4))
    bow = F.array(lower(x0, z0), lower(x1, z1), lower(x1, z0), lower(x0, z1))
    second = F.when(F.col("k") == 0, upright).when(F.col("k") == 1, line).when(F.col("k") == 2, bent).when(F.col("k") == 3, bow).when(F.col("k") == 6, F.slice(box, 1, 2)).otherwise(box)
    f = f.withColumns({"first": first, "second": second}).withColumns({"n": F.size("first"), "m": F.size("second")})
    count = lambda start, n: F.sequence(start, start + n - 1)
    wall = F.array(F.lit(0), F.lit(1), F.when(F.col("k") == 5, F.lit(-1)).otherwise(F.lit(2)))
    shell = F.array(F.array(count(F.lit(0), F.col("n"))), F.array(wall), F.array(F.when(F.col("k") == 5, F.concat(count(F.col("n"), F.col("m")), F.array(F.lit(99)))).otherwise(count(F.col("n"), F.col("m")))))
    kinds = F.array(F.struct(F.lit("WallSurface").alias("type")), F.struct(F.lit("RoofSurface").alias("type")))
    solid = F.struct(F.lit("Solid").alias("type"), F.lit("2.2").alias("lod"), F.array(shell).alias("boundaries"), F.struct(kinds.alias("surfaces"), F.array(F.array(*map(F.lit, (1, 0, 1)))).alias("values")).alias("semantics"))
    plainer = F.struct(F.lit("Solid").alias("type"), F.lit("1.3").alias("lod"), F.array(shell).alias("boundaries"), F.struct(kinds.alias("surfaces"), F.array(F.array(*map(F.lit, (1, 0, 1)))).alias("values")).alias("semantics"))
    solids: Column = F.when(F.col("k") == 4, F.array(solid, solid)).otherwise(F.array(plainer, solid))
    feature = F.struct(F.lit("CityJSONFeature").alias("type"), F.col("fid").cast("string").alias("id"), F.concat("first", "second").alias("vertices"), F.create_map(F.lit("b"), F.struct(solids.alias("geometry"))).alias("CityObjects"))
    lines = f.select(F.to_json(feature).alias("value"), F.pmod(F.xxhash64("fid"), F.lit(PARTS)).alias("part"))
    steps = F.array(*[F.lit(1 / STEP)] * 3)
    head = F.struct(F.lit("CityJSON").alias("type"), F.struct(steps.alias("scale"), F.array(*map(F.lit, (WEST, NORTH, 0.0))).alias("translate")).alias("transform"), F.struct(F.lit(CRS).alias("referenceSystem")).alias("metadata"))
    return lines.union(lines.select("part").distinct().select(F.to_json(head), "part"))


def _faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roof faces of the written sequences, with plane and fault."""
    path = scratch(spark, "city")
    city_lines(spark, sf_dir).repartition("part").write.partitionBy("part").text(path)
    read = city_models.roofs(spark, path, CRS, WEST, NORTH).withColumnRenamed("fault", "unread")
    fitted = planes.fit(read)
    return fitted.withColumn("fault", F.coalesce("unread", "fault")).withColumn("fid", F.col("feature").cast("long"))


@query(
    f"""WITH rings AS ({_RINGS}), edges AS ({_EDGES}),
b AS (SELECT fid, f.x0 AS x0, f.z0 AS z0, f.x0 + 16 * (1 + fid % 2) AS x1, f.z0 + 16 * (1 + fid // 2 % 2) AS z1, (fid % 5 - 2) / 4.0::DOUBLE AS sx, (fid % 7 - 3) / 8.0::DOUBLE AS sz, fid % 11 + 10 + 1 / 64.0::DOUBLE AS up FROM f_footprints f WHERE fid % 16 > 6),
cells AS (SELECT b.*, x, z FROM b, LATERAL (SELECT unnest(range(x0::BIGINT, x1::BIGINT)) AS x), LATERAL (SELECT unnest(range(z0::BIGINT, z1::BIGINT)) AS z)),
hit AS (SELECT c.fid, x, z, sum(CASE WHEN (az > z + 0.5::DOUBLE) <> (bz > z + 0.5::DOUBLE) AND x + 0.5::DOUBLE < ax + (z + 0.5::DOUBLE - az) * (bx - ax) / nullif(bz - az, 0) THEN 1 ELSE 0 END) % 2 = 1
  OR bool_or((bx - ax) * (z + 0.5::DOUBLE - az) = (bz - az) * (x + 0.5::DOUBLE - ax) AND x + 0.5::DOUBLE BETWEEN least(ax, bx) AND greatest(ax, bx) AND z + 0.5::DOUBLE BETWEEN least(az, bz) AND greatest(az, bz)) AS own
  FROM cells c JOIN edges e ON c.fid = e.fid GROUP BY c.fid, x, z)
SELECT fid, x, z, floor(greatest(up + 1 - sx * (x + 0.5::DOUBLE - x0), CASE WHEN own THEN up + sx * (x + 0.5::DOUBLE - x0) + sz * (z + 0.5::DOUBLE - z0) ELSE -1e9::DOUBLE END))::BIGINT AS top FROM cells JOIN hit USING (fid, x, z)""",
    "f_footprints",
)
def f20_roof_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest whole height of a feature's fitted roof faces per cell; features with a faulty face have none."""
    return planes.heights(_faces(spark, sf_dir), "fid")


@query(
    "SELECT fid, CASE WHEN fid % 16 = 4 THEN 1 ELSE 2 END::BIGINT AS faces, CASE fid % 16 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(FAULTS)) + " END AS fault FROM f_footprints",
    "f_footprints",
)
def s19_roof_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roof faces read per feature and what is wrong with them: upright, without width, bent, crossing, two solids, unknown corners, too few."""
    return _faces(spark, sf_dir).groupBy("fid").agg(F.count("*").alias("faces"), F.min("fault").alias("fault"))
