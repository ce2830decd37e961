"""Survey coverage of planned tiles: union areas by distinct cells, so overlapping surveys count once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import ranges


def tile_coverage(tiles: DataFrame, surveys: DataFrame, size: int, halo: int) -> DataFrame:
    """tiles (tx, tz) and survey boxes (x0, z0, x1, z1 in cells, half-open; asset) -> per tile the surveys that meet it with its
    halo, those without an asset, and the covered shares: of the core and of the padded tile by any survey, of the core by
    surveys with an asset. A tile without surveys has zeros. Boxes are exact where their corners lie on cells.
    """
    boxes = tiles.select("tx", "tz", (F.col("tx") * size).alias("x0"), (F.col("tz") * size).alias("z0"), ((F.col("tx") + 1) * size).alias("x1"), ((F.col("tz") + 1) * size).alias("z1"))
    named = ranges.range_join(boxes, surveys, size, halo).groupBy("tx", "tz").agg(F.count("*").alias("surveys"), F.count_if(~F.col("r_asset")).alias("missing"))
    cells = surveys.select("asset", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"), "z0", "z1").select("asset", "x", F.explode(F.sequence("z0", F.col("z1") - 1)).alias("z"))
    cells = cells.groupBy("x", "z").agg(F.bool_or("asset").alias("asset"))
    seen = ranges.with_halo(cells, size, halo).groupBy("tx", "tz").agg(F.count("*").alias("padded"), F.count_if("core").alias("core"), F.count_if(F.col("core") & F.col("asset")).alias("ready"))
    share = lambda c, side: F.coalesce(c, F.lit(0)) / (side * side)
    whole = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = tiles.select("tx", "tz").join(named, ["tx", "tz"], "left").join(seen, ["tx", "tz"], "left")
    return out.select("tx", "tz", whole("surveys"), whole("missing"), share("core", size).alias("core_indexed"), share("padded", size + 2 * halo).alias("halo_indexed"), share("ready", size).alias("core_available"))
