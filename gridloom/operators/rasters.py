"""Point-to-cell aggregation and cell-table operators. Unknown is null throughout, never a sentinel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Point classes that make up a surface, and the ground class.
SURFACE, GROUND = (1, 2, 6, 9, 17), 2


def surfaces(points: DataFrame, keys: list[Column], height: str, cls: str = "cls") -> DataFrame:
    """Per cell: sum and count of ground returns (their quotient is the terrain height) and the highest surface return."""
    ground, h = F.col(cls) == GROUND, F.col(height)
    return points.groupBy(*keys).agg(F.sum(F.when(ground, h)).alias("ground_sum"), F.count_if(ground).alias("n_ground"), F.max(F.when(F.col(cls).isin(*SURFACE), h)).alias("dsm"), F.count("*").alias("n"))


def histogram(points: DataFrame, keys: list[Column], cls: str = "cls") -> DataFrame:
    return points.groupBy(*keys, F.col(cls).alias("cls")).agg(F.count("*").alias("n"))


def neighbours(cells: DataFrame, offsets: list[tuple[int, int]], columns: list[str], x: str = "x", z: str = "z") -> DataFrame:
    """A stencil: each row goes to the cells that see it at one of the offsets, as (x, z, dx, dz, columns)."""
    at = F.explode(F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dz")) for a, b in offsets]))
    out = cells.select(F.col(x), F.col(z), at.alias("o"), *columns)
    return out.select((F.col(x) - F.col("o.dx")).alias(x), (F.col(z) - F.col("o.dz")).alias(z), F.col("o.dx").alias("dx"), F.col("o.dz").alias("dz"), *columns)


def square(r: int) -> list[tuple[int, int]]:
    return [(a, b) for b in range(-r, r + 1) for a in range(-r, r + 1)]


def diamond(r: int) -> list[tuple[int, int]]:
    return [(a, b) for a, b in square(r) if abs(a) + abs(b) <= r]


SIDES = [(1, 0), (-1, 0), (0, 1), (0, -1)]


def focal(cells: DataFrame, offsets: list[tuple[int, int]], columns: list[str], **aggs: Column) -> DataFrame:
    """Aggregates over each known cell's neighbourhood (only cells of the table are results)."""
    seen = neighbours(cells, offsets, columns).groupBy("x", "z").agg(*[a.alias(k) for k, a in aggs.items()])
    return cells.join(seen, ["x", "z"], "left")


def dilate(cells: DataFrame, offsets: list[tuple[int, int]], steps: int = 1) -> DataFrame:
    out = cells.select("x", "z")
    for _ in range(steps):
        out = neighbours(out, offsets, []).select("x", "z").distinct()
    return out


def downsample(cells: DataFrame, factor: int, hit: Column, least: int) -> DataFrame:
    """Cells of the coarser grid with at least `least` hits."""
    return cells.groupBy(F.floor(F.col("x") / factor).alias("x"), F.floor(F.col("z") / factor).alias("z")).agg(F.count_if(hit).alias("hits")).where(F.col("hits") >= least)


def fill_highest(cells: DataFrame, wanted: DataFrame, value: str) -> DataFrame:
    """wanted (x, z): the cell's own value, or the highest of its 3 x 3 neighbours, or null."""
    seen = neighbours(cells, square(1), [value]).groupBy("x", "z").agg(F.max(F.when((F.col("dx") == 0) & (F.col("dz") == 0), F.col(value))).alias("own"), F.max(value).alias("near"))
    return wanted.select("x", "z").join(seen, ["x", "z"], "left").select("x", "z", F.coalesce("own", "near").alias(value), F.col("own").isNull().alias("filled"))


def valid_scan(dtm: Column, dsm: Column) -> Column:
    """Both heights known, plausible, and the surface not below the ground."""
    return F.coalesce((dsm >= dtm - 1) & (dsm - dtm <= 700) & (dtm > -100) & (dtm < 800), F.lit(False))


def ndvi(red: Column, nir: Column) -> Column:
    return F.when(nir + red > 0, (nir - red) / (nir + red))


def resolve(edits: DataFrame, keys: list[str], priority: str = "priority", seq: str = "seq") -> DataFrame:
    """One edit per cell: higher priority wins, then the first; rejected counts the others."""
    w = Window.partitionBy(*keys)
    ranked = edits.withColumn("_k", F.row_number().over(w.orderBy(F.desc(priority), seq))).withColumn("rejected", F.count("*").over(w) - 1)
    return ranked.where("_k = 1").drop("_k")


def seams(cells: DataFrame, value: str, edge: int = 16) -> DataFrame:
    """Height jumps across cell edges at multiples of `edge`, on both axes: axis, x, z, jump."""
    out = None
    for axis, other in (("x", "z"), ("z", "x")):
        w = Window.partitionBy(other).orderBy(axis)
        step = cells.withColumn("_p", F.lag(axis).over(w)).withColumn("_v", F.lag(value).over(w)).where((F.col(axis) - F.col("_p") == 1) & (F.pmod(F.col(axis), F.lit(edge)) == 0))
        part = step.select(F.lit(axis).alias("axis"), "x", "z", (F.col(value) - F.col("_v")).alias("jump"))
        out = part if out is None else out.unionByName(part)
    return out
