"""Neighbourhood operators over coarse cells (16 m)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import focal, rasters
from gridloom.plans.registry import query
from gridloom.sources import derived as d

NEAR = "abs(b.x-a.x)<=1 AND abs(b.z-a.z)<=1"


@query(f"SELECT a.x, a.z, round(quantile_cont(b.top,0.5),6)::DOUBLE AS median_top, count(*)::BIGINT AS known FROM f_coarse a JOIN f_coarse b ON {NEAR} GROUP BY 1,2", "f_coarse")
def w1_median_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = d.f_coarse(spark, sf_dir)
    return rasters.focal(c.select("x", "z", "top"), rasters.square(1), ["top"], median_top=F.round(F.expr("percentile(top, 0.5)"), 6), known=F.count("*")).select("x", "z", "median_top", "known")


@query(f"WITH k AS (SELECT * FROM f_coarse WHERE n%3<>0), w AS (SELECT x, z FROM f_coarse) SELECT a.x, a.z, coalesce(max(CASE WHEN b.x=a.x AND b.z=a.z THEN b.top END), max(b.top))::BIGINT AS top, (max(CASE WHEN b.x=a.x AND b.z=a.z THEN b.top END) IS NULL) AS filled FROM w a LEFT JOIN k b ON {NEAR} GROUP BY 1,2", "f_coarse")
def w2_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = d.f_coarse(spark, sf_dir)
    return rasters.fill_highest(c.where("n % 3 <> 0"), c, "top")


@query("SELECT a.x, a.z, round(quantile_cont(b.ground,0.5),6)::DOUBLE AS local_ground FROM f_coarse a JOIN f_coarse b ON abs(b.x-a.x)<=7 AND abs(b.z-a.z)<=7 GROUP BY 1,2", "f_coarse")
def w3_wide_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 15 x 15 median by tiles with a halo; the result does not depend on the tile size."""
    m = focal.tiled(d.f_coarse(spark, sf_dir), "ground", 32, 7, focal.window_median(7), "local_ground")
    return m.select("x", "z", F.round("local_ground", 6).alias("local_ground"))


@query("SELECT a.x, a.z, round(sum(b.top * CASE abs(b.x-a.x) WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END * CASE abs(b.z-a.z) WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END) / sum(CASE abs(b.x-a.x) WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END * CASE abs(b.z-a.z) WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END), 6)::DOUBLE AS smooth FROM f_coarse a JOIN f_coarse b ON abs(b.x-a.x)<=2 AND abs(b.z-a.z)<=2 GROUP BY 1,2", "f_coarse")
def w4_weighted_smoothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weighted 5 x 5 mean of the known cells; the weights fall off from the centre along both axes."""
    weight = F.expr("(CASE abs(dx) WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END) * (CASE abs(dz) WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 1 END)")
    c = d.f_coarse(spark, sf_dir).select("x", "z", "top")
    return rasters.focal(c, rasters.square(2), ["top"], smooth=F.round(F.sum(F.col("top") * weight) / F.sum(weight), 6)).select("x", "z", "smooth")


@query("SELECT a.x, a.z, a.top::BIGINT AS top FROM f_coarse a JOIN f_coarse b ON abs(b.x-a.x)<=2 AND abs(b.z-a.z)<=2 GROUP BY a.x, a.z, a.top HAVING a.top=max(b.top) AND a.top>=1840", "f_coarse")
def w5_local_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = d.f_coarse(spark, sf_dir).select("x", "z", "top")
    return rasters.focal(c.withColumnRenamed("top", "own"), rasters.square(2), ["own"], m=F.max("own")).where("own = m AND own >= 1840").select("x", "z", F.col("own").alias("top"))


@query("WITH k AS (SELECT a.x, a.z, b.top%4 AS colour, count(*) AS n FROM f_coarse a JOIN f_coarse b ON abs(b.x-a.x)<=2 AND abs(b.z-a.z)<=2 AND a.ground%2=b.ground%2 GROUP BY 1,2,3), r AS (SELECT *, row_number() OVER (PARTITION BY x, z ORDER BY n DESC, colour) AS k FROM k) SELECT x, z, colour, n::BIGINT AS n FROM r WHERE k=1", "f_coarse")
def w6_majority_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most common colour among neighbours on the same plane."""
    c = d.f_coarse(spark, sf_dir).select("x", "z", (F.col("ground") % 2).alias("plane"), (F.col("top") % 4).alias("colour"))
    seen = rasters.neighbours(c, rasters.square(2), ["plane", "colour"]).join(c.select("x", "z", F.col("plane").alias("own")), ["x", "z"]).where("plane = own")
    k = seen.groupBy("x", "z", "colour").agg(F.count("*").alias("n"))
    return k.groupBy("x", "z").agg(F.max_by("colour", F.struct("n", -F.col("colour"))).alias("colour"), F.max("n").alias("n"))


@query(f"SELECT a.x, a.z, count(*)::BIGINT AS alike FROM f_coarse a JOIN f_coarse b ON {NEAR} AND NOT (a.x=b.x AND a.z=b.z) AND a.top//10=b.top//10 GROUP BY 1,2 HAVING count(*)>=5", "f_coarse")
def w7_plane_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = d.f_coarse(spark, sf_dir).select("x", "z", F.floor(F.col("top") / 10).alias("h"))
    around = [o for o in rasters.square(1) if o != (0, 0)]
    seen = rasters.neighbours(c, around, ["h"]).join(c.select("x", "z", F.col("h").alias("own")), ["x", "z"])
    return seen.groupBy("x", "z").agg(F.count_if(F.col("h") == F.col("own")).alias("alike")).where("alike >= 5")


SIDE = "abs(b.x-a.x)+abs(b.z-a.z)=1"


@query(f"SELECT a.x, a.z, greatest(least(min(coalesce(b.top, a.ground)), CASE WHEN count(b.x)<4 THEN a.ground ELSE 100000 END), a.ground)::BIGINT AS floor FROM f_coarse a LEFT JOIN f_coarse b ON {SIDE} GROUP BY a.x, a.z, a.ground", "f_coarse")
def w8_shell_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest exposed side of a column: its lowest side neighbour, its own ground where one is missing."""
    c = d.f_coarse(spark, sf_dir).select("x", "z", "top", "ground")
    seen = rasters.neighbours(c, rasters.SIDES, ["top"]).groupBy("x", "z").agg(F.min("top").alias("low"), F.count("*").alias("sides"))
    floor = F.when(F.coalesce("sides", F.lit(0)) < 4, F.col("ground")).otherwise(F.greatest("low", "ground"))
    return c.join(seen, ["x", "z"], "left").select("x", "z", floor.alias("floor"))


@query(f"SELECT a.x, a.z, b.x-a.x AS dx, b.z-a.z AS dz, (a.top-b.top)::BIGINT AS exposed FROM f_coarse a JOIN f_coarse b ON {SIDE} AND a.top>b.top", "f_coarse")
def w9_exposed_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side faces above the neighbouring column, by direction."""
    c = d.f_coarse(spark, sf_dir)
    seen = rasters.neighbours(c.select("x", "z", F.col("top").alias("other")), rasters.SIDES, ["other"]).join(c.select("x", "z", "top"), ["x", "z"]).where("top > other")
    return seen.select("x", "z", F.col("dx").cast("long").alias("dx"), F.col("dz").cast("long").alias("dz"), (F.col("top") - F.col("other")).alias("exposed"))


@query(f"SELECT DISTINCT a.x, a.z FROM f_coarse a JOIN f_coarse b ON {SIDE} AND b.ground%3=a.ground%3 AND b.top>=a.top+20", "f_coarse")
def w10_ledges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = d.f_coarse(spark, sf_dir)
    seen = rasters.neighbours(c.select("x", "z", F.col("top").alias("o_top"), F.col("ground").alias("o_ground")), rasters.SIDES, ["o_top", "o_ground"]).join(c, ["x", "z"])
    return seen.groupBy("x", "z").agg(F.bool_or((F.col("o_ground") % 3 == F.col("ground") % 3) & (F.col("o_top") >= F.col("top") + 20)).alias("ledge")).where("ledge").select("x", "z")


@query("WITH s AS (SELECT x, z FROM f_coarse WHERE n%5=0), o AS (SELECT dx, dz FROM (SELECT unnest(range(-2,3)) AS dx), (SELECT unnest(range(-2,3)) AS dz) WHERE abs(dx)+abs(dz)<=2) SELECT DISTINCT s.x+o.dx AS x, s.z+o.dz AS z FROM s, o EXCEPT SELECT x, z FROM s", "f_coarse")
def w11_dilation_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-cell band around the chosen cells."""
    s = d.f_coarse(spark, sf_dir).where("n % 5 = 0").select("x", "z")
    return rasters.dilate(s, rasters.diamond(1), 2).join(s, ["x", "z"], "left_anti")


@query("SELECT a.x, a.z, round(sqrt(min((a.x-b.x)*(a.x-b.x)+(a.z-b.z)*(a.z-b.z))),6)::DOUBLE AS distance FROM f_coarse a LEFT JOIN (SELECT x, z FROM f_coarse WHERE n%7=0) b ON abs(a.x-b.x)<=8 AND abs(a.z-b.z)<=8 AND (a.x-b.x)*(a.x-b.x)+(a.z-b.z)*(a.z-b.z)<=64 GROUP BY 1,2", "f_coarse")
def w12_distance_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = d.f_coarse(spark, sf_dir).withColumn("hit", (F.col("n") % 7 == 0).cast("double"))
    out = focal.tiled(c, "hit", 32, 8, focal.distance_to_known(8), "distance")
    return out.select("x", "z", F.round(F.when(~F.isnan("distance"), F.col("distance")), 6).alias("distance"))


@query(
    """WITH k AS (SELECT x, z, top FROM f_coarse WHERE n%7=0), p AS (SELECT a.x, a.z, k.top, row_number() OVER (PARTITION BY a.x, a.z ORDER BY (a.x-k.x)*(a.x-k.x)+(a.z-k.z)*(a.z-k.z), k.z, k.x) AS i FROM f_coarse a JOIN k ON (a.x-k.x)*(a.x-k.x)+(a.z-k.z)*(a.z-k.z)<=64)
SELECT x, z, top::DOUBLE AS filled FROM p WHERE i=1""",
    "f_coarse",
)
def w12_nearest_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell with the top of the nearest known cell within eight, ties to the least z, then x."""
    c = d.f_coarse(spark, sf_dir).withColumn("top", F.when(F.col("n") % 7 == 0, F.col("top")))
    return focal.tiled(c, "top", 32, 8, focal.nearest_value(8), "filled").where("filled IS NOT NULL")


@query("SELECT a.x, a.z, round(a.top-quantile_cont(b.top,0.5),6)::DOUBLE AS contrast FROM f_coarse a JOIN f_coarse b ON abs(b.x-a.x)<=5 AND abs(b.z-a.z)<=5 GROUP BY a.x, a.z, a.top", "f_coarse")
def w13_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = focal.tiled(d.f_coarse(spark, sf_dir), "top", 32, 5, focal.contrast(5), "contrast")
    return out.select("x", "z", F.round("contrast", 6).alias("contrast"))


@query("SELECT x//2 AS x, z//2 AS z, sum((top>=1840)::INT)::BIGINT AS hits FROM f_coarse GROUP BY 1,2 HAVING sum((top>=1840)::INT)>=2", "f_coarse")
def w14_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.downsample(d.f_coarse(spark, sf_dir), 2, F.col("top") >= 1840, 2)


@query(
    """WITH q AS (SELECT pid, x_dm, z_dm, x_dm//160 AS gx, z_dm//160 AS gz FROM f_places), k AS (SELECT pid, sum(c.top*(CASE WHEN c.x=gx THEN 160-x_dm%160 ELSE x_dm%160 END)*(CASE WHEN c.z=gz THEN 160-z_dm%160 ELSE z_dm%160 END)) AS s, count(*) AS n FROM q JOIN f_coarse c ON c.x IN (gx,gx+1) AND c.z IN (gz,gz+1) GROUP BY 1)
SELECT pid, round(s/25600.0,6)::DOUBLE AS height FROM k WHERE n=4""",
    "f_places f_coarse",
)
def w16_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four surrounding nodes weighted by distance; a missing node gives no row."""
    p = d.f_places(spark, sf_dir).withColumn("o", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])))
    part = lambda v, o: F.when(F.col(o) == 0, 160 - F.col(v) % 160).otherwise(F.col(v) % 160)
    p = p.select("pid", (F.floor(F.col("x_dm") / 160) + F.col("o.a")).alias("x"), (F.floor(F.col("z_dm") / 160) + F.col("o.b")).alias("z"), (part("x_dm", "o.a") * part("z_dm", "o.b")).alias("w"))
    k = p.join(d.f_coarse(spark, sf_dir), ["x", "z"]).groupBy("pid").agg(F.sum(F.col("top") * F.col("w")).alias("s"), F.count("*").alias("n")).where("n = 4")
    return k.select("pid", F.round(F.col("s") / 25600.0, 6).alias("height"))


@query("SELECT 'x' AS axis, a.x, a.z, (a.top-b.top)::BIGINT AS jump FROM f_coarse a JOIN f_coarse b ON b.z=a.z AND b.x=a.x-1 WHERE a.x%16=0 UNION ALL SELECT 'z', a.x, a.z, (a.top-b.top)::BIGINT FROM f_coarse a JOIN f_coarse b ON b.x=a.x AND b.z=a.z-1 WHERE a.z%16=0", "f_coarse")
def w20_seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.seams(d.f_coarse(spark, sf_dir), "top")
