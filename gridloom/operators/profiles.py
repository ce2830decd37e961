"""Kerbs from cross profiles: heights sampled along a way's normals, the first rise that lasts, a median per side."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

#: Metres between stations, from a way's ends, between samples and to the last one; the least rise.
EVERY, FROM_ENDS, STEP, REACH, RISE = 2.0, 1.0, 0.5, 18.0, 0.08
#: Samples at either end of a profile that start no rise, stations that must agree (number, share of all).
MARGIN, LEAST_FOUND, LEAST_SHARE = 3, 3, 0.25
#: The narrowest half carriageway, and how far beyond the estimate a measured one may lie (factor, metres).
NARROWEST, WIDER, FARTHER = 2.5, 2.2, 6.0
_LAST = int(REACH / STEP) - 1


def _legs(path: Column) -> Column:
    """Per leg of a path: start, way and the length so far, legs without length left out."""
    from_to = lambda q, p: F.struct(p["x"].alias("x"), p["z"].alias("z"), (q["x"] - p["x"]).alias("dx"), (q["z"] - p["z"]).alias("dz"))
    legs = F.transform(F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0))), lambda q, i: from_to(q, F.get(path, i)))
    legs = F.transform(legs, lambda g: g.withField("length", F.sqrt(g["dx"] * g["dx"] + g["dz"] * g["dz"])))
    return F.filter(legs, lambda g: g["length"] > 0)


def place_at(legs: Column, ends: Column, d: Column) -> Column:
    """struct(x, z) at a distance along the legs; ends are their summed lengths."""
    k = F.least(F.size(F.filter(ends, lambda e: e < d)), F.size(ends) - 1)
    g = F.get(legs, k)
    t = (d - F.get(ends, k)) / g["length"] + 1
    return F.struct((g["x"] + t * g["dx"]).alias("x"), (g["z"] + t * g["dz"]).alias("z"))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt to as many tasks as a shuffle has, however small their file: each becomes hundreds of rows before the next shuffle."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def stations(ways: DataFrame, key: str, path: str = "path") -> DataFrame:
    """key, d, side, x, z, nx, nz: a row per station and side; side 1 is the left one when z points south. Ways under 4 m have none."""
    legs = spread(ways.where(F.size(path) > 1), key).select(key, _legs(F.col(path)).alias("legs"))
    sums = F.transform("legs", lambda g, i: F.aggregate(F.slice("legs", 1, i + 1), F.lit(0.0), lambda s, h: s + h["length"]))
    long = legs.withColumn("ends", sums).withColumn("length", F.get("ends", F.size("ends") - 1)).where("length >= 4")
    n = F.ceil((F.col("length") - 2 * FROM_ENDS) / EVERY).cast("int")
    each = long.withColumn("d", F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: FROM_ENDS + i * EVERY)))
    place = lambda d: place_at(F.col("legs"), F.col("ends"), d)
    each = each.select(key, "d", place(F.col("d")).alias("p"), place(F.greatest(F.lit(0.0), F.col("d") - 1)).alias("a"), place(F.least(F.col("length"), F.col("d") + 1)).alias("b"))
    dx, dz = F.col("b.x") - F.col("a.x"), F.col("b.z") - F.col("a.z")
    each = each.select(key, "d", "p", dx.alias("dx"), dz.alias("dz"), F.sqrt(dx * dx + dz * dz).alias("n")).where("n > 0")
    sides = each.withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1))))
    return sides.select(key, "d", "side", F.col("p.x").alias("x"), F.col("p.z").alias("z"), (-F.col("dz") / F.col("n") * F.col("side")).alias("nx"), (F.col("dx") / F.col("n") * F.col("side")).alias("nz"))


def first_rise(profile: Column) -> Column:
    """Metres to the first lasting rise of a profile (array of struct<i, h, stop>, all samples in order), or null.

    A rise starts at sample i when heights two and three samples on both lie RISE above the lowest of the last three up to i;
    the samples named must be known. It ends before the first stopped sample, and leaves MARGIN samples at either end.
    """
    stop = F.array_min(F.transform(F.filter(profile, lambda s: s["stop"]), lambda s: s["i"]))
    once = F.struct(F.transform(profile, lambda s: s["h"]).alias("h"), (F.coalesce(stop, F.lit(_LAST + 1)) - MARGIN).alias("limit"))

    def first(p: Column) -> Column:
        h = lambda i: F.get(p["h"], i)
        before = lambda i: F.least(h(i - 2), h(i - 1), h(i))  # least passes nulls by
        rises = lambda i: (i < p["limit"]) & h(i).isNotNull() & (F.least(h(i + 2), h(i + 3)) - before(i) >= RISE) & h(i + 2).isNotNull() & h(i + 3).isNotNull()
        found = F.filter(F.sequence(F.lit(MARGIN), F.lit(_LAST - MARGIN)), lambda i: F.coalesce(rises(i), F.lit(False)))
        return (F.get(found, F.lit(0)) + 2) * STEP

    return F.transform(F.array(once), first)[0]  # as a lambda's argument the heights and the end are found once, not per sample


def _packed(heights: DataFrame, size: int, halo: int) -> DataFrame:
    """heights (cx, cz, h, stop) -> tx, tz, at, h, stop: the cells of a tile and its halo, batch by batch, as bytes (places in it as 4 bytes, each less the one before, which shuffles compress; heights as 8, stops as 1)."""
    wide = size + 2 * halo

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cx, cz = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            h, stop = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64), batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            found = []
            for dx in range(-1, 2):  # the tile that a cell lies in and those whose halo holds it
                for dz in range(-1, 2):
                    tx, tz = cx // size + dx, cz // size + dz
                    x, z = cx - tx * size + halo, cz - tz * size + halo
                    i = np.flatnonzero((x >= 0) & (x < wide) & (z >= 0) & (z < wide))
                    found.append((tx[i], tz[i], (x * wide + z)[i], i))
            tx, tz, at, i = (np.concatenate(v) for v in zip(*found))
            order = np.lexsort((at, tz, tx))
            tx, tz, at, i = tx[order], tz[order], at[order].astype("<i4"), i[order]
            first = np.flatnonzero(np.concatenate([[True], (tx[1:] != tx[:-1]) | (tz[1:] != tz[:-1])])) if len(tx) else np.zeros(0, int)
            cut = list(zip(first.tolist(), [*first[1:].tolist(), len(tx)]))
            steps = [np.diff(at[a:b], prepend=at.dtype.type(0)).tobytes() for a, b in cut]
            parts = [pa.array(steps, pa.binary()), *(pa.array([v[a:b].tobytes() for a, b in cut], pa.binary()) for v in (h[i], stop[i]))]
            yield pa.RecordBatch.from_arrays([pa.array(tx[first], pa.int64()), pa.array(tz[first], pa.int64()), *parts], names=["tx", "tz", "at", "h", "stop"])

    return heights.mapInArrow(run, "tx long, tz long, at binary, h binary, stop binary")


def kerbs(ways: DataFrame, key: str, heights: DataFrame, cell: float, path: str = "path") -> DataFrame:
    """key, side, samples, detections, kerb, iqr from heights (cx, cz, h, stop; a row a cell) on a grid of `cell` metres.

    kerb is the median distance of a side's rises where at least LEAST_FOUND stations and LEAST_SHARE of them have one, else
    null; iqr the distance of the quartiles where there are LEAST_FOUND. Unknown heights and NaN are null; cells without a row
    are unknown and no stop. Cells are shuffled once, packed by tiles of fixed size with a halo as wide as a profile, and
    stations once, a row each: their 35 samples are read where both meet. So neither samples nor single cells are shuffled,
    and a group holds a tile's cells and stations.
    """
    halo = ceil(REACH / cell) + 2
    size = max(256, 4 * halo)
    tile = lambda c: F.floor(F.floor(F.col(c) / cell) / size).cast("long")
    at = stations(ways, key, path).withColumns({"tx": tile("x"), "tz": tile("z")})
    known = heights.where("cx IS NOT NULL AND cz IS NOT NULL").select(F.col("cx").cast("long").alias("cx"), F.col("cz").cast("long").alias("cz"), F.coalesce(F.col("h").cast("double"), F.lit(float("nan"))).alias("h"), F.coalesce("stop", F.lit(False)).alias("stop"))
    wide, out = size + 2 * halo, (np.arange(_LAST + 1) + 1) * STEP

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        h, stop = np.full(wide * wide if n else 0, np.nan), np.zeros(wide * wide if n else 0, bool)
        for places, a, b in zip(*(right[c].to_pylist() for c in ("at", "h", "stop"))) if n else ():
            places = np.cumsum(np.frombuffer(places, "<i4"))
            h[places], stop[places] = np.frombuffer(a), np.frombuffer(b, bool)
        x, z, nx, nz, tx, tz = (left[c].to_numpy()[:, None] for c in ("x", "z", "nx", "nz", "tx", "tz"))
        i, j = (np.floor((p + q * out) / cell) - t * size + halo for p, q, t in ((x, nx, tx), (z, nz, tz)))
        inside = ((i >= 0) & (i < wide) & (j >= 0) & (j < wide)).ravel()  # all but samples without a place
        place = np.where(inside, (i * wide + j).ravel(), 0).astype(np.int64)
        s, e = np.where(inside, h[place], np.nan) if n else h, stop[place] & inside if n else stop
        item = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(_LAST + 1, dtype=np.int32), n)), pa.array(s, mask=np.isnan(s)), pa.array(e)], ["i", "h", "stop"])
        profile = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (_LAST + 1)), item)
        return pa.Table.from_arrays([left[key].combine_chunks(), left["side"].combine_chunks(), profile], names=[key, "side", "profile"])

    kind = StructType([at.schema[key], at.schema["side"], StructField("profile", ArrayType(StructType([StructField("i", IntegerType()), StructField("h", DoubleType()), StructField("stop", BooleanType())])))])
    profiles = at.groupBy("tx", "tz").cogroup(_packed(known, size, halo).groupBy("tx", "tz")).applyInArrow(read, kind)
    sides = profiles.select(key, "side", first_rise(F.col("profile")).alias("t")).groupBy(key, "side")
    found = sides.agg(F.count("*").alias("samples"), F.count("t").alias("detections"), F.percentile("t", F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"))
    enough = F.col("detections") >= F.greatest(F.lit(LEAST_FOUND), LEAST_SHARE * F.col("samples"))
    return found.select(key, "side", "samples", "detections", F.when(enough, F.col("q")[1]).alias("kerb"), F.when(F.col("detections") >= LEAST_FOUND, F.col("q")[2] - F.col("q")[0]).alias("iqr"))


def carriageway(ways: DataFrame, key: str, measured: DataFrame, estimate: Column) -> DataFrame:
    """Per side of each way, the columns of measured (kerbs; null where a side has no row) with half and how: the kerb where it is plausible, else the estimate (struct<value, how>)."""
    sides = ways.select(key, estimate.alias("_e")).withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1))))
    kerb, guess = F.col("kerb"), F.col("_e.value")
    good = (kerb >= NARROWEST) & (kerb <= F.greatest(WIDER * guess, guess + FARTHER))
    chosen = sides.join(measured.hint("merge"), [key, "side"], "left")
    return chosen.select(*measured.columns, F.when(good, kerb).otherwise(guess).alias("half"), F.when(good, F.lit("kerb profile")).otherwise(F.col("_e.how")).alias("how"))
