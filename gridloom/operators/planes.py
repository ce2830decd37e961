"""Planes of roof faces: best fit, rejection of faces that carry none, heights per cell."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.polygons import edges, row_spans

#: Below this the vertical part of a unit normal counts as none.
UPRIGHT = 1e-7
#: Below this a width in metres or an area in square metres counts as none.
NOTHING = 1e-9
_RESULT = "fault string, slope_x double, slope_z double, x double, y double, z double"


def _fault(sizes: np.ndarray, corners: np.ndarray, tolerance: float) -> tuple:
    """fault, or None with slopes and the mean of one face's corners; sizes are those of its closed rings."""
    if not len(sizes) or min(sizes) < 4:
        return ("empty", *[None] * 5)
    if not np.isfinite(corners).all():
        return ("not finite", *[None] * 5)
    ends = np.cumsum(sizes)
    middle = np.delete(corners, ends - 1, axis=0).mean(axis=0)
    near = corners - middle
    singular, (_, _, normal) = np.linalg.svd(np.delete(near, ends - 1, axis=0), full_matrices=False)[1:]
    if singular[1] < NOTHING:
        return ("collinear", *[None] * 5)
    if abs(normal[1]) < UPRIGHT:
        return ("vertical", *[None] * 5)
    if np.abs(near @ normal).max() > tolerance:
        return ("not planar", *[None] * 5)
    # seen from above: edges as (start, way); two cut each other where each parts the other's ends
    start = np.delete(near[:, ::2], ends - 1, axis=0)
    way = np.delete(np.roll(near[:, ::2], -1, axis=0), ends - 1, axis=0) - start
    side = lambda p: way[:, None, 0] * (p[None, :, 1] - start[:, None, 1]) - way[:, None, 1] * (p[None, :, 0] - start[:, None, 0])
    parted = side(start) * side(start + way) < 0
    if (parted & parted.T).any():
        return ("crossing", *[None] * 5)
    shell = near[: sizes[0], ::2]
    if abs(np.sum(shell[:-1, 0] * shell[1:, 1] - shell[1:, 0] * shell[:-1, 1])) < NOTHING:
        return ("no area", *[None] * 5)
    return (None, -normal[0] / normal[1], -normal[2] / normal[1], *middle)


def _planes(sizes: pd.Series, numbers: pd.Series, tolerance: pd.Series) -> pd.DataFrame:
    blank = lambda v: np.zeros(0) if v is None else np.asarray(v, dtype=float)
    rows = [_fault(blank(s).astype(int), blank(n).reshape(-1, 3), t) for s, n, t in zip(sizes, numbers, tolerance, strict=True)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _RESULT.split(", ")]).astype({c: float for c in ("slope_x", "slope_z", "x", "y", "z")})


def fit(faces: DataFrame, rings: str = "rings", tolerance: str = "tolerance") -> DataFrame:
    """Adds plane (slope_x, slope_z, x, y, z: a point of it) and fault to faces of closed rings of struct<x, y, z>, y upwards.

    The plane is that of least squared distances: its normal is the last singular vector of the corners around their mean, in
    Arrow batches. All corners count once, a ring's repeated last one does not. fault is null and plane set, or plane is null and
    fault one of: empty (no ring, or one of fewer than three corners), not finite (null and NaN too), collinear, vertical, not
    planar (a corner farther from the plane than tolerance; a null tolerance allows all), crossing (edges cut each other seen
    from above), no area. Faces and extra columns stay; those named like a result are replaced.
    """
    sizes = F.transform(rings, lambda r: F.coalesce(F.size(r), F.lit(0)))
    numbers = F.flatten(F.flatten(F.transform(rings, lambda r: F.transform(F.coalesce(r, F.array()), lambda p: F.array(p["x"].cast("double"), p["y"].cast("double"), p["z"].cast("double"))))))
    # a filter on its result would otherwise run the fit a second time below
    found = F.pandas_udf(_planes, _RESULT).asNondeterministic()(sizes, numbers, F.coalesce(F.col(tolerance).cast("double"), F.lit(float("inf"))))
    out = faces.withColumn("_fit", found)
    plane = F.struct(*(F.col("_fit")[a].alias(a) for a in ("slope_x", "slope_z", "x", "y", "z")))
    return out.withColumn("fault", F.col("_fit.fault")).withColumn("plane", F.when(F.col("fault").isNull(), plane)).drop("_fit")


def heights(fitted: DataFrame, key: str, offset: float = 0.0, rings: str = "rings") -> DataFrame:
    """key, x, z, top: the highest whole height of a key's sound faces per unit cell whose centre they hold (or have on an edge).

    A key with a faulty face has no cells, since its roof is not known whole; nor has a null key. Faces shuffle once by their
    key and are one row a key from then on: its rows of cells follow one by one and are never held together.
    """
    face = F.struct(F.col(rings).alias("rings"), F.col("plane").alias("plane"))
    judged = fitted.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("fault").alias("_faults"), F.collect_list(face).alias("_f")).where("_faults = 0")
    held = judged.select(key, F.filter(F.transform("_f", lambda f: F.struct(edges(f["rings"]).alias("e"), f["plane"].alias("plane"))), lambda f: F.size(f["e"]) > 0).alias("_f")).where("size(_f) > 0")
    bound = lambda pick: pick(F.transform("_f", lambda f: pick(F.transform(f["e"], lambda e: e["az"]))))
    rows = held.withColumn("z", F.explode(F.sequence(F.floor(bound(F.array_min)).cast("long"), F.floor(bound(F.array_max)).cast("long"))))
    spans = lambda f: F.transform(row_spans(f["e"], F.col("z") + 0.5), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), f["plane"].alias("plane")))
    rows = rows.withColumn("_s", F.flatten(F.transform("_f", spans))).where("size(_s) > 0").drop("_f")
    # where spans begin or end a row is cut, so that a part has the same planes throughout and a cell is plain arithmetic: no function of arrays a cell
    cuts = F.array_sort(F.array_distinct(F.flatten(F.transform("_s", lambda s: F.array(s["a"], s["b"] + 1)))))
    over = lambda a, b: F.array_distinct(F.transform(F.filter("_s", lambda s: (s["a"] <= a) & (b <= s["b"])), lambda s: s["plane"]))
    part = lambda a, b: F.struct(a.alias("a"), b.alias("b"), over(a, b).alias("p"))
    parts = rows.withColumn("_c", cuts).withColumn("_part", F.explode(F.transform(F.slice("_c", 1, F.size("_c") - 1), lambda c, i: part(c, F.get("_c", i + 1) - 1)))).where("size(_part.p) > 0")
    parts = parts.select(key, "z", "_part.*")
    down = lambda p: p["slope_z"] * (F.col("z") + 0.5 - p["z"])
    top = lambda p, x, z: F.floor(p["y"] + p["slope_x"] * (x + 0.5 - p["x"]) + z + offset)
    two = [F.struct(*(F.get("p", F.lit(i))[c].alias(c) for c in ("y", "slope_x", "x")), down(F.get("p", F.lit(i))).alias("down")).alias(f"p{i}") for i in (0, 1)]
    more = F.when(F.size("p") > 2, F.transform(F.sequence("a", "b"), lambda x: F.array_max(F.transform("p", lambda p: top(p, x, down(p))))))
    flat = parts.select(key, "z", "a", "b", F.size("p").alias("_n"), *two, more.alias("_tops"))
    flat = flat.select(key, "z", "a", "_n", *(F.col(f"p{i}")[c].alias(f"{c}{i}") for i in (0, 1) for c in ("y", "slope_x", "x", "down")), "_tops", F.explode(F.sequence("a", "b")).alias("_x"))
    at = lambda i: F.floor(F.col(f"y{i}") + F.col(f"slope_x{i}") * (F.col("_x") + 0.5 - F.col(f"x{i}")) + F.col(f"down{i}") + offset)
    highest = F.when(F.col("_n") == 1, at(0)).when(F.col("_n") == 2, F.greatest(at(0), at(1))).otherwise(F.get("_tops", F.col("_x") - F.col("a")))
    return flat.select(key, F.col("_x").alias("x"), "z", highest.alias("top")).where("top IS NOT NULL")
