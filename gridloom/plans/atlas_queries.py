"""Whole-Earth pages planned from the positions that fall on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import atlas
from gridloom.plans.registry import query
from gridloom.sources import derived as d

# The oracle takes Krueger's series in the third flattening n and the scale from eastings, the engine Snyder's in e squared.
_N = "(1 / 298.257223563::DOUBLE) / (2 - 1 / 298.257223563::DOUBLE)"
_ARC = "ra * (({0}) + (-1.5 * n + 9.0 / 16 * pow(n, 3)) * sin(2 * ({0})) + (15.0 / 16 * n * n - 15.0 / 32 * pow(n, 4)) * sin(4 * ({0})) - 35.0 / 48 * pow(n, 3) * sin(6 * ({0})))"
_FOOT = "(({0}) + (1.5 * n - 27.0 / 32 * pow(n, 3)) * sin(2 * ({0})) + (21.0 / 16 * n * n - 55.0 / 32 * pow(n, 4)) * sin(4 * ({0})) + 151.0 / 96 * pow(n, 3) * sin(6 * ({0})) + 1097.0 / 512 * pow(n, 4) * sin(8 * ({0})))"
_ALPHA = ("(n / 2 - 2 * n * n / 3 + 5 * pow(n, 3) / 16)", "(13 * n * n / 48 - 3 * pow(n, 3) / 5)", "(61 * pow(n, 3) / 240)")
_EAST = " + ".join(f"{a} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, a in enumerate(_ALPHA, 1))
_NORTH = " + ".join(f"{a} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, a in enumerate(_ALPHA, 1))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pid, east (degrees from longitude -180), lat over the Earth from 85 degrees south to 85 north."""
    return d.f_places(spark, sf_dir).select("pid", (F.col("x_dm") / 57).alias("east"), (F.col("z_dm") / 120 - 85).alias("lat"))


@query(
    f"""WITH k0 AS (SELECT {_N} AS n), k1 AS (SELECT n, 6378137.0::DOUBLE / (1 + n) * (1 + n * n / 4 + pow(n, 4) / 64) AS ra, 4 * n / pow(1 + n, 2) AS e2 FROM k0), k AS (SELECT *, ra * pi() AS meridian, ceil(ra * pi() / 16384)::BIGINT AS bands FROM k1),
b AS (SELECT *, least(floor(({_ARC.format("radians(z_dm / 120.0::DOUBLE - 85)")} + meridian / 2) / (meridian / bands))::BIGINT, bands - 1) AS band, x_dm / 57.0::DOUBLE AS around FROM f_places, k),
m AS (SELECT *, {_FOOT.format("((band + 0.5::DOUBLE) / bands - 0.5::DOUBLE) * pi()")} AS mid, {_FOOT.format("(band / bands::DOUBLE - 0.5::DOUBLE) * pi()")} AS s, {_FOOT.format("((band + 1) / bands::DOUBLE - 0.5::DOUBLE) * pi()")} AS nn FROM b),
c AS (SELECT *, greatest(ceil(2 * pi() * 6378137.0::DOUBLE * cos(mid) / sqrt(1 - e2 * pow(sin(mid), 2)) / 16384), 1)::BIGINT AS cols FROM m),
g AS (SELECT DISTINCT n, ra, e2, band, cols, mid, s, nn, least(floor(around / 360 * cols)::BIGINT, cols - 1) AS col FROM c),
q AS (SELECT *, pi() / cols * (2 * CASE WHEN side = 2 THEN 0 WHEN side = 3 THEN 1 ELSE i / 16.0::DOUBLE END - 1) AS lam, CASE WHEN side = 0 THEN s WHEN side = 1 THEN nn ELSE s + (nn - s) * i / 16 END AS phi FROM g, range(0, 17) r(i), range(0, 4) t(side)),
t AS (SELECT *, sinh(atanh(sin(phi)) - sqrt(e2) * atanh(sqrt(e2) * sin(phi))) AS tau FROM q), h AS (SELECT *, atan2(tau, cos(lam)) AS xi, asinh(sin(lam) / sqrt(tau * tau + cos(lam) * cos(lam))) AS eta FROM t),
p AS (SELECT *, ra * (eta + {_EAST}) AS x, ra * (xi + {_NORTH}) - {_ARC.format("mid")} AS y, pow(6378137.0::DOUBLE, 2) * (1 - e2) / pow(1 - e2 * pow(sin(phi), 2), 2) AS rr FROM h),
f AS (SELECT band, col, (floor(min(x) / 256) * 256 - 512)::BIGINT AS west, (floor(min(y) / 256) * 256 - 512)::BIGINT AS south, (ceil(max(x) / 256) * 256 + 512)::BIGINT AS east, (ceil(max(y) / 256) * 256 + 512)::BIGINT AS north, round(max(x * x / (2 * rr) + pow(x, 4) / (24 * rr * rr)) * 1e6, 3) AS scale_ppm FROM p GROUP BY band, col)
SELECT band, col AS "column", west, south, east, north, (east - west) // 256 AS "columns", (north - south) // 256 AS "rows", scale_ppm, scale_ppm <= 1.5 AS within FROM f""",
    "f_places",
)
def f13_page_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page that holds a position: its envelope in tiles with halo, columns, rows and sampled scale error."""
    band, column = atlas.page_east(F.col("east"), F.col("lat"))
    pages = positions(spark, sf_dir).select(band.alias("band"), column.alias("column")).distinct()
    return atlas.page_manifests(pages).select("band", "column", "west", "south", "east", "north", "columns", "rows", F.round("scale_ppm", 3).alias("scale_ppm"), F.col("fault").isNull().alias("within"))
