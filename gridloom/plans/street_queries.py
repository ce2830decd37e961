"""Streets: kerbs measured from cross profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.attributes import half_width
from gridloom.operators import profiles
from gridloom.plans.registry import query
from gridloom.sources import derived as d


def streets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A way per place in a block of 64 m, in one of four directions, with its tags; and the block's heights in cells of 1 m.

    Kerbs lie at whole metres on both sides; some cells are unknown, some blocks have a stop line.
    """
    p = d.f_places(spark, sf_dir).select("pid", (64 * (F.col("pid") % 1024)).alias("bx"), F.expr("64 * (pid div 1024)").alias("bz"), (F.col("pid") % 4).alias("way"), (8 + 2 * (F.col("x_dm") % 13)).alias("length"), (3 + F.col("x_dm") % 9).alias("low"), (3 + F.col("z_dm") % 16).alias("high"))
    at = lambda u: F.struct(*((F.col(b) + F.when(F.col("way") < 2, along).otherwise(across)).cast("double").alias(n) for n, b, along, across in (("x", "bx", u, F.lit(32.25)), ("z", "bz", F.lit(32.25), u))))
    ends = (F.lit(16.25), 16.25 + F.col("length"))
    path = F.when(F.col("way") % 2 == 0, F.array(at(ends[0]), at(ends[1]))).otherwise(F.array(at(ends[1]), at(ends[0])))
    tags = F.map_from_arrays(F.array(F.lit("highway"), F.lit("lanes"), F.lit("width")), F.array(F.when(F.col("pid") % 3 == 0, "primary").otherwise("residential"), (F.col("pid") % 5 + 1).cast("string"), F.when(F.col("pid") % 8 == 1, "9 m")))
    ways = p.select("pid", path.alias("path"), tags.alias("tags"))
    cells = profiles.spread(p, "pid").withColumn("u", F.explode(F.sequence(F.lit(15), F.lit(50)))).withColumn("v", F.explode(F.sequence(F.lit(12), F.lit(52)))).where("(7 * u + 11 * v + pid) % 19 > 0")
    raised = F.when((F.col("v") - 32 > F.col("high")) | (32 - F.col("v") > F.col("low")), 0.125).otherwise(0.0)
    along, across = (F.when(F.col("way") < 2, F.col(a)).otherwise(F.col(b)) for a, b in (("u", "v"), ("v", "u")))
    return ways, cells.select((F.col("bx") + along).alias("cx"), (F.col("bz") + across).alias("cz"), (F.col("pid") % 7 + raised).alias("h"), ((F.col("pid") % 6 == 0) & (F.col("v") == 37)).alias("stop"))


@query(
    """WITH p AS (SELECT pid, pid % 4 AS way, 8 + 2 * (x_dm % 13) AS length, 3 + x_dm % 9 AS low, 3 + z_dm % 16 AS high FROM f_places),
s AS (SELECT p.*, side, d, i, floor(16.25::DOUBLE + CASE WHEN way % 2 = 0 THEN d ELSE length - d END)::BIGINT AS u, floor(32.25::DOUBLE + side * CASE WHEN way IN (0, 3) THEN 1 ELSE -1 END * (i + 1) / 2.0::DOUBLE)::BIGINT AS v
  FROM p, LATERAL (SELECT unnest(range(1, length - 1, 2)) AS d), (VALUES (1), (-1)) k(side), range(0, 35) r(i)),
h AS (SELECT *, CASE WHEN (7 * u + 11 * v + pid) % 19 > 0 AND v BETWEEN 12 AND 52 THEN pid % 7 + CASE WHEN v - 32 > high OR 32 - v > low THEN 0.125::DOUBLE ELSE 0 END END AS h, pid % 6 = 0 AND v = 37 AND (7 * u + 11 * v + pid) % 19 > 0 AS stop FROM s),
w AS (SELECT *, min(h) OVER (PARTITION BY pid, side, d ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS before, lead(h, 2) OVER (PARTITION BY pid, side, d ORDER BY i) AS h2, lead(h, 3) OVER (PARTITION BY pid, side, d ORDER BY i) AS h3, min(CASE WHEN stop THEN i END) OVER (PARTITION BY pid, side, d) AS ended FROM h),
f AS (SELECT pid, side, d, min((i + 2) / 2.0::DOUBLE) FILTER (i >= 3 AND i < coalesce(ended, 35) - 3 AND h IS NOT NULL AND h2 - before >= 0.08::DOUBLE AND h3 - before >= 0.08::DOUBLE) AS t FROM w GROUP BY 1, 2, 3),
q AS (SELECT pid, side, count(*) AS samples, count(t) AS detections, CASE WHEN count(t) >= greatest(3, count(*) / 4.0::DOUBLE) THEN quantile_cont(t, 0.5) END AS kerb, CASE WHEN count(t) >= 3 THEN quantile_cont(t, 0.75) - quantile_cont(t, 0.25) END AS iqr FROM f GROUP BY 1, 2),
e AS (SELECT *, CASE WHEN pid % 8 = 1 THEN 4.5::DOUBLE ELSE ((pid % 5 + 1) * 3.2::DOUBLE + CASE WHEN pid % 3 = 0 THEN 0 ELSE 2.4::DOUBLE END) / 2 END AS guess FROM q)
SELECT pid, side, samples, detections, kerb, iqr, CASE WHEN kerb >= 2.5 AND kerb <= greatest(2.2::DOUBLE * guess, guess + 6) THEN kerb ELSE guess END AS half, CASE WHEN kerb >= 2.5 AND kerb <= greatest(2.2::DOUBLE * guess, guess + 6) THEN 'kerb profile' WHEN pid % 8 = 1 THEN 'width tag' ELSE 'lanes' END AS how FROM e""",
    "f_places",
)
def a26_kerb_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per way and side: stations, rises, median kerb distance and spread; half the carriageway, measured where plausible, else estimated."""
    ways, heights = streets(spark, sf_dir)
    return profiles.carriageway(ways, "pid", profiles.kerbs(ways, "pid", heights, 1.0), half_width(F.col("tags")))
