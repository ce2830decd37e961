"""Whole-Earth pages: bands of equal meridian distance from the south pole, columns of about equal width in each band."""

from __future__ import annotations

from math import ceil, pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.frame import AXIS, E2, EP2, M, Frame, to_block, to_geographic

# A page's target span, its tiles and the halo of its sources in metres, samples a side, parts in a million.
SPAN, TILE, HALO, SEGMENTS, SCALE_BUDGET = 16_384, 256, 512, 16, 1.5
HALF_MERIDIAN = AXIS * M[0] * pi / 2  # the series' sine terms vanish at the poles
BANDS = ceil(2 * HALF_MERIDIAN / SPAN)
BAND_HEIGHT = 2 * HALF_MERIDIAN / BANDS


def meridian_distance(lat: Column) -> Column:
    """Metres along the meridian from the south pole."""
    p = F.radians(lat)
    return HALF_MERIDIAN + AXIS * (M[0] * p - M[1] * F.sin(2 * p) + M[2] * F.sin(4 * p) - M[3] * F.sin(6 * p))


def latitude_at(distance: Column) -> Column:
    """The latitude at a meridian distance from the south pole (footpoint series)."""
    e = (1 - sqrt(1 - E2)) / (1 + sqrt(1 - E2))
    mu = (distance - HALF_MERIDIAN) / (AXIS * M[0])
    return F.degrees(mu + (3 * e / 2 - 27 * e**3 / 32) * F.sin(2 * mu) + (21 * e**2 / 16 - 55 * e**4 / 32) * F.sin(4 * mu) + 151 * e**3 / 96 * F.sin(6 * mu) + 1097 * e**4 / 512 * F.sin(8 * mu))


def columns_in(band: Column) -> Column:
    """Pages of a band: as many of the target span as its middle parallel needs."""
    p = F.radians(latitude_at((band + 0.5) * BAND_HEIGHT))
    return F.greatest(F.ceil(2 * pi * AXIS * F.cos(p) / F.sqrt(1 - E2 * F.pow(F.sin(p), 2)) / SPAN), F.lit(1))


def page(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(band, column) of a position; longitudes wrap, and at the poles the longitude is 0. Null outside the latitude range."""
    return page_east(F.pmod(lon + 180, F.lit(360.0)), lat)


def page_east(east: Column, lat: Column) -> tuple[Column, Column]:
    """As page, from degrees east of longitude -180 (0 to 360): exact on the borders of pages, where 180 off and on again would round."""
    band = F.when(F.abs(lat) <= 90, F.least(F.floor(meridian_distance(lat) / BAND_HEIGHT), F.lit(BANDS - 1)))
    n = columns_in(band)
    return band, F.least(F.floor(F.when(F.abs(lat) == 90, 180.0).otherwise(east) / 360 * n), n - 1)


def page_id(band: Column, column: Column) -> Column:
    return F.format_string("b%04d/c%04d", band.cast("int"), column.cast("int"))


def page_centre(band: Column, column: Column) -> tuple[Column, Column]:
    """(lon, lat) of a page's middle."""
    return (column + 0.5) / columns_in(band) * 360 - 180, latitude_at((band + 0.5) * BAND_HEIGHT)


def page_local(lon: Column, lat: Column, centre_lon: Column, centre_lat: Column) -> tuple[Column, Column]:
    """(x, z) on a page's own projection, whose centre is a column: the frame's forward series about longitude 0, less the centre's place."""
    flat = Frame(lat_0=0.0, lon_0=0.0, west=0.0, north=0.0)
    around = F.pmod(lon - centre_lon + 180, F.lit(360.0)) - 180
    x, z = to_block(around, lat, flat)
    _, z0 = to_block(F.lit(0.0), centre_lat, flat)
    return x, z - z0


def page_geographic(x: Column, z: Column, centre_lon: Column, centre_lat: Column) -> tuple[Column, Column]:
    """The inverse of page_local."""
    flat = Frame(lat_0=0.0, lon_0=0.0, west=0.0, north=0.0)
    _, z0 = to_block(F.lit(0.0), centre_lat, flat)
    lon, lat = to_geographic(x, z + z0, flat)
    return F.pmod(lon + centre_lon + 180, F.lit(360.0)) - 180, lat


def scale_factor(lon: Column, lat: Column, centre_lon: Column) -> Column:
    """Scale of the Transverse Mercator about centre_lon, alike in all directions (Snyder, equation 8-11)."""
    p = F.radians(lat)
    a = F.radians(F.pmod(lon - centre_lon + 180, F.lit(360.0)) - 180) * F.cos(p)
    a2, t, c = a * a, F.pow(F.tan(p), 2), EP2 * F.pow(F.cos(p), 2)
    return 1 + (1 + c) * a2 / 2 + (5 - 4 * t + 42 * c + 13 * c * c - 28 * EP2) * a2 * a2 / 24 + (61 - 148 * t + 16 * t * t) * a2 * a2 * a2 / 720


def page_manifests(pages: DataFrame) -> DataFrame:
    """What a page needs to be built, for each distinct (band, column): page, centre, its envelope in whole tiles and the halo, columns, rows, scale_ppm, fault.

    west, south, east, north are metres from the page's centre, north upwards, from samples along the page's four sides. fault is
    null, or: outside (no such page), pole (the first and last band, whose pages have another projection, are not planned),
    scale (the sampled error is above SCALE_BUDGET); with a fault of the first two kinds the figures are null.
    """
    b, c, per = F.col("band"), F.col("column"), F.col("per")
    valid = F.coalesce((b >= 0) & (b < BANDS) & (c >= 0) & (c < per), F.lit(False))
    fault = F.when(~valid, "outside").when((b == 0) | (b == BANDS - 1), "pole")
    known = pages.select("band", "column", columns_in(b).alias("per")).withColumn("fault", fault)
    places = {"clon": (c + 0.5) / per * 360 - 180, "clat": latitude_at((b + 0.5) * BAND_HEIGHT), "w": c / per * 360 - 180, "e": (c + 1) / per * 360 - 180, "s": latitude_at(b * BAND_HEIGHT), "n": latitude_at((b + 1) * BAND_HEIGHT)}
    planned = known.withColumns({k: F.when(F.col("fault").isNull(), v) for k, v in places.items()})
    part = F.col("i") / SEGMENTS
    side = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    across, up = F.col("w") + (F.col("e") - F.col("w")) * part, F.col("s") + (F.col("n") - F.col("s")) * part
    # a page with a fault is one sample without a place: no filter, which Spark would push down with all formulas in it
    samples = planned.withColumn("i", F.explode_outer(F.when(F.col("fault").isNull(), F.sequence(F.lit(0), F.lit(SEGMENTS))))).withColumn("at", F.explode(F.array(side(across, F.col("s")), side(across, F.col("n")), side(F.col("w"), up), side(F.col("e"), up)))).select("band", "column", "clon", "clat", "fault", "at.lon", "at.lat")
    x, z = page_local(F.col("lon"), F.col("lat"), F.col("clon"), F.col("clat"))
    low = lambda v: F.floor(F.min(v) / TILE) * TILE - HALO
    high = lambda v: F.ceil(F.max(v) / TILE) * TILE + HALO
    samples = samples.withColumns({"x": x, "y": -z, "ppm": F.abs(scale_factor(F.col("lon"), F.col("lat"), F.col("clon")) - 1) * 1e6})
    found = samples.groupBy("band", "column", "clon", "clat", "fault").agg(low("x").alias("west"), low("y").alias("south"), high("x").alias("east"), high("y").alias("north"), F.max("ppm").alias("scale_ppm"))
    figures = {"columns": F.expr(f"(east - west) div {TILE}"), "rows": F.expr(f"(north - south) div {TILE}"), "fault": F.coalesce("fault", F.when(F.col("scale_ppm") > SCALE_BUDGET, "scale"))}
    return found.withColumns(figures).select(page_id(b, c).alias("page"), "band", "column", "clon", "clat", "west", "south", "east", "north", "columns", "rows", "scale_ppm", "fault")
