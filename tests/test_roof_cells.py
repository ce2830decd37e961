"""Roof cells where up to four faces lie over each other, against each face alone; a cell calls no function of arrays."""

import random
from math import floor

import pytest
from pyspark.sql import functions as F

from gridloom.operators import planes

FACE = "k int, rings array<array<struct<x:double,y:double,z:double>>>, tolerance double"


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_faces(spark, seed):
    r = random.Random(seed)
    faces = []
    for k in range(12):
        for _ in range(1 + k % 4):
            x0, z0, w, d, y, sx, sz = r.randrange(6), r.randrange(6), r.randrange(1, 9), r.randrange(1, 9), r.uniform(0, 9), r.choice((-1, 0, 0.5)), r.choice((0, 0.25))
            ring = [(x0, z0), (x0 + w, z0), (x0 + w, z0 + d), (x0, z0 + d), (x0, z0)]
            faces.append((k, [[(float(x), y + sx * (x - x0) + sz * (z - z0), float(z)) for x, z in ring]], 0.01))
    fitted = planes.fit(spark.createDataFrame(faces, FACE)).cache()
    want = {}
    for i, f in enumerate(fitted.collect()):
        (ring,) = f.rings
        for x in range(int(ring[0].x), int(ring[1].x)):
            for z in range(int(ring[0].z), int(ring[2].z)):
                top = floor(f.plane.y + f.plane.slope_x * (x + 0.5 - f.plane.x) + f.plane.slope_z * (z + 0.5 - f.plane.z) + 0.25)
                want[f.k, x, z] = max(top, want.get((f.k, x, z), top))
    cells = planes.heights(fitted, "k", 0.25)
    got = cells.collect()
    assert {(c.k, c.x, c.z): c.top for c in got} == want and len(got) == len(want)
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan[: plan.index("Generate explode(sequence(a")]
