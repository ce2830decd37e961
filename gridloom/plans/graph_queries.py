"""Components, greedy selection and bounded reach."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import graph, rasters
from gridloom.plans.registry import query
from gridloom.sources import derived as d

WET = "wet AS (SELECT x, z, top FROM f_coarse WHERE n%4=0)"
STEP = "abs(a.x-b.x)+abs(a.z-b.z)=1"


@query(
    f"""WITH {WET}, r(x, z, label) AS (SELECT x, z, x*16777216+z FROM wet UNION SELECT b.x, b.z, r.label FROM r JOIN wet b ON abs(r.x-b.x)+abs(r.z-b.z)=1)
SELECT x, z, min(label)::BIGINT AS label FROM r GROUP BY 1,2""",
    "f_coarse",
)
def g1_cell_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.cell_components(d.f_coarse(spark, sf_dir).where("n % 4 = 0"), rasters.SIDES)


@query(
    f"""WITH {WET}, r(x, z, label) AS (SELECT x, z, x*16777216+z FROM wet UNION SELECT b.x, b.z, r.label FROM r JOIN wet b ON abs(r.x-b.x)+abs(r.z-b.z)=1), l AS (SELECT x, z, min(label) AS label FROM r GROUP BY 1,2)
SELECT label::BIGINT AS label, count(*)::BIGINT AS cells, min(top)::BIGINT AS low, max(top)::BIGINT AS high FROM l JOIN wet USING (x, z) GROUP BY 1""",
    "f_coarse",
)
def a31_component_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    wet = d.f_coarse(spark, sf_dir).where("n % 4 = 0")
    return graph.cell_components(wet, rasters.SIDES).join(wet, ["x", "z"]).groupBy("label").agg(F.count("*").alias("cells"), F.min("top").alias("low"), F.max("top").alias("high"))


@query(f"WITH {WET}, r(x, z, step) AS (SELECT x, z, 0 FROM wet WHERE top>=1848 UNION SELECT b.x, b.z, r.step+1 FROM r JOIN wet b ON abs(r.x-b.x)+abs(r.z-b.z)=1 WHERE r.step<3) SELECT x, z, min(step)::INT AS step FROM r GROUP BY 1,2", "f_coarse")
def g4_bounded_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    wet = d.f_coarse(spark, sf_dir).where("n % 4 = 0")
    return graph.reach(wet.where("top >= 1848"), wet, rasters.SIDES, 3)


@query()
def g5_greedy_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree tops: highest first, none within three cells of one that stays. Order-dependent, so beyond plain SQL."""
    tops = d.f_coarse(spark, sf_dir).where("top >= 1845").withColumn("id", F.col("x") * (1 << 24) + F.col("z"))
    ring = [o for o in rasters.square(3) if o != (0, 0) and o[0] ** 2 + o[1] ** 2 <= 9]
    seen = rasters.neighbours(tops.select("x", "z", F.col("id").alias("b")), ring, ["b"]).join(tops.select("x", "z", F.col("id").alias("a")), ["x", "z"])
    return graph.suppress(tops.select("id", "x", "z", "top"), seen.select("a", "b"), [-F.col("top")]).select("x", "z", "top")


@query()
def g6_crowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per crown; region growing is beyond SQL, tests check the kernel."""
    from gridloom.operators import crowns

    cells = crowns.segment(d.f_coarse(spark, sf_dir), "top", 1830)
    return cells.groupBy("crown").agg(F.count("*").alias("cells"), F.min("x").alias("west"), F.max("x").alias("east"))


@query(
    f"""WITH paved AS (SELECT x, z FROM f_coarse WHERE n%5<>0), hole AS (SELECT x, z, top FROM f_coarse WHERE n%5=0), r(x, z, label) AS (SELECT x, z, x*16777216+z FROM hole UNION SELECT b.x, b.z, r.label FROM r JOIN hole b ON abs(r.x-b.x)+abs(r.z-b.z)=1),
l AS (SELECT x, z, min(label) AS label FROM r GROUP BY 1,2), e AS (SELECT DISTINCT label FROM l JOIN (VALUES (1,0),(-1,0),(0,1),(0,-1)) o(dx,dz) ON NOT EXISTS (SELECT 1 FROM f_coarse c WHERE c.x=l.x+dx AND c.z=l.z+dz))
SELECT label::BIGINT AS label, count(*)::BIGINT AS cells, round(quantile_cont(top,0.5),6)::DOUBLE AS median_top FROM l JOIN hole USING (x, z) WHERE label NOT IN (SELECT label FROM e) GROUP BY 1 HAVING count(*)<8""",
    "f_coarse",
)
def g3_enclosed_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small unpaved components that touch no unknown cell."""
    cells = d.f_coarse(spark, sf_dir)
    hole = cells.where("n % 5 = 0").select("x", "z", "top")
    label = graph.checkpointed(graph.cell_components(hole, rasters.SIDES))
    known = rasters.neighbours(cells, rasters.SIDES, []).groupBy("x", "z").agg(F.count("*").alias("sides"))
    open_ = label.join(known, ["x", "z"], "left").where("coalesce(sides, 0) < 4").select("label").distinct()
    inside = label.join(open_, "label", "left_anti").join(hole, ["x", "z"])
    return inside.groupBy("label").agg(F.count("*").alias("cells"), F.round(F.expr("percentile(top, 0.5)"), 6).alias("median_top")).where("cells < 8")
