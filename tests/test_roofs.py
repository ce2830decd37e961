"""City models read by rule, planes against a singular value decomposition, heights per cell."""

import json
import random
from math import cos, inf, nan, sin

import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import planes
from gridloom.sources import city_models

FACE = "k int, rings array<array<struct<x double, y double, z double>>>, tolerance double, fault string".replace("x double, y double, z double", "x:double,y:double,z:double")


def closed(points):
    return [*points, points[0]]


def faces(spark, rows):
    return spark.createDataFrame([(k, rings, 0.05, "old") for k, rings in rows], FACE)


def test_planes_equal_the_decomposition(spark):
    r, rows, want = random.Random(3), [], {}
    for k in range(120):
        turns, sx, sz, cx, cz = sorted(r.uniform(0, 6.28) for _ in range(r.randrange(3, 9))), r.uniform(-9, 9), r.uniform(-9, 9), r.uniform(-1000, 1000), r.uniform(-1000, 1000)
        p = [(cx + 5 * cos(t), 10 + sx * 5 * cos(t) + sz * 5 * sin(t) + r.uniform(-0.004, 0.004), cz + 5 * sin(t)) for t in turns]
        normal = np.linalg.svd(np.array(p) - np.mean(p, axis=0), full_matrices=False)[2][-1]
        want[k] = (-normal[0] / normal[1], -normal[2] / normal[1])
        rows.append((k, [closed(p)]))
    got = {x.k: x for x in planes.fit(faces(spark, rows)).collect()}
    assert len(got) == 120 and all(x.fault is None for x in got.values())
    assert all(np.allclose((got[k].plane.slope_x, got[k].plane.slope_z), want[k], rtol=1e-6, atol=1e-6) for k in want)


def test_faults_of_faces(spark):
    flat = [(0.0, 1.0, 0.0), (4.0, 1.0, 0.0), (4.0, 1.0, 4.0), (0.0, 1.0, 4.0)]
    r = random.Random(5)
    upright = []
    for _ in range(40):
        a, x, z = r.uniform(0, 6.28), r.uniform(-900, 900), r.uniform(-900, 900)
        upright.append(closed([(x + t * cos(a), y, z + t * sin(a)) for t, y in ((0, 3.0), (7, 3.5), (7, 9.0), (2, 8.0))]))
    cases = [
        ([closed(flat)], None), ([closed([(x, y + x / 2, z) for x, y, z in flat])], None), ([closed(flat), closed([(1.0, 1.0, 1.0), (2.0, 1.0, 1.0), (2.0, 1.0, 2.0)])], None),
        (None, "empty"), ([], "empty"), ([[]], "empty"), ([flat[:2]], "empty"), ([closed(flat), []], "empty"), ([closed([(nan, 1.0, 0.0), *flat[1:]])], "not finite"), ([closed([(0.0, inf, 0.0), *flat[1:]])], "not finite"), ([closed([(None, 1.0, 0.0), *flat[1:]])], "not finite"),
        ([closed([(1e3, 2.0, 7.0), (1e3 + 1, 3.0, 8.0), (1e3 + 3, 5.0, 10.0)])], "collinear"), ([closed([(5.0, 5.0, 5.0)] * 3)], "collinear"), ([closed([(0.0, 2.0, 0.0), *flat[1:]])], "not planar"), ([closed([flat[0], flat[2], flat[1], flat[3]])], "crossing"),
        *(([u], "vertical") for u in upright),
    ]
    got = {x.k: x for x in planes.fit(faces(spark, [(k, c[0]) for k, c in enumerate(cases)])).collect()}
    assert {k: x.fault for k, x in got.items()} == {k: c[1] for k, c in enumerate(cases)}
    assert all((x.plane is None) == (x.fault is not None) for x in got.values())


def test_heights_take_the_highest_face_and_leave_holes(spark):
    low = closed([(0.0, 2.25, 0.0), (4.0, 2.25, 0.0), (4.0, 2.25, 4.0), (0.0, 2.25, 4.0)])
    hole = closed([(1.0, 2.25, 1.0), (2.0, 2.25, 1.0), (2.0, 2.25, 2.0), (1.0, 2.25, 2.0)])
    slope = closed([(2.0, 0.0, 0.0), (4.0, 8.0, 0.0), (4.0, 8.0, 4.0), (2.0, 0.0, 4.0)])
    fitted = planes.fit(faces(spark, [(1, [low, hole]), (1, [slope]), (2, [low]), (2, None)]))
    got = {(c.k, c.x, c.z): c.top for c in planes.heights(fitted, "k").collect()}
    assert got == {(1, x, z): (6 if x == 3 else 2) for x in range(4) for z in range(4) if (x, z) != (1, 1)}
    assert planes.heights(fitted.limit(0), "k").count() == 0


def head(**change):
    return {"type": "CityJSON", "transform": {"scale": [0.5, 0.5, 0.25], "translate": [100, 200, 0]}, "metadata": {"referenceSystem": "here"}, **change}


def solid(faces, names=("RoofSurface",), values=None, lod="2.2"):
    return {"type": "Solid", "lod": lod, "boundaries": [faces], "semantics": {"surfaces": [{"type": n} for n in names], "values": [values if values is not None else [0] * len(faces)]}}


def feature(i, *geometry, vertices=((0, 0, 4), (2, 0, 4), (2, 2, 8))):
    return {"type": "CityJSONFeature", "id": i, "vertices": vertices, "CityObjects": {"b": {"geometry": list(geometry)}, "c": {}}}


def test_sequences_are_read_by_rule(spark, tmp_path):
    tri = [[0, 1, 2]]
    surface = {"type": "MultiSurface", "lod": "2.2", "boundaries": [tri]}
    cases = {
        "good": (feature("good", surface, solid([tri], lod="1.2"), solid([tri, tri], ("WallSurface", "RoofSurface"), [0, 1])), None), "number": (feature("number", solid([tri], lod=2.2)), None), "two": (feature("two", solid([tri]), solid([tri])), "solids"), "none": (feature("none", solid([tri], ("WallSurface",))), "solids"),
        "bare": (feature("bare"), "solids"), "short": (feature("short", solid([tri, tri], values=[0])), "semantics"), "index": (feature("index", solid([tri], values=[1])), "semantics"), "corner": (feature("corner", solid([[[0, 1, 3]]])), "vertex number"), "minus": (feature("minus", solid([[[0, 1, -1]]])), "vertex number"),
        "flat": (feature("flat", solid([tri]), vertices=((0, 0), (1, 1), (2, 2))), "vertices"), "twice": (feature("twice", solid([tri])), "repeated"),
    }
    lines = [json.dumps(c[0]) for c in cases.values()]
    (tmp_path / "a.jsonl").write_text("\n".join([*lines[:4], "", json.dumps(head()), *lines[4:], lines[-1], "{ no json"]))
    for name, first in {"crs": [head(metadata={"referenceSystem": "there"})], "scale": [head(transform={"scale": [1, 1, 0], "translate": [0, 0, 0]})], "lone": [], "pair": [head(), head()]}.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, [*first, feature(name, solid([tri]))])))
    got = city_models.roofs(spark, str(tmp_path), "here", 100.0, 200.0).collect()
    want = {k: c[1] for k, c in cases.items()} | {"crs": "reference system", "scale": "transform", "lone": "header", "pair": "header", None: "no feature"}
    assert {r.feature: r.fault for r in got} == want and len(got) == len(want) + 1
    good = next(r for r in got if r.feature == "good")
    assert good.face == 1 and good.tolerance == 0.5
    assert [tuple(p) for p in good.rings[0]] == [(0.0, 1.0, 0.0), (1.0, 1.0, 0.0), (1.0, 2.0, -1.0), (0.0, 1.0, 0.0)]
    assert all((r.rings is None) == (r.fault is not None) for r in got)
    assert city_models.roofs(spark, str(tmp_path), "here").where(F.lit(False)).count() == 0
