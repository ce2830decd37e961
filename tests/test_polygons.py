"""Clipping, tile plans and lines over cells against plain versions."""

import random

from pyspark.sql import functions as F

from gridloom.operators import polygons

RING = "fid int, ring array<struct<x:double,z:double>>"


def _inside(ring, x, z):
    found = False
    for (ax, az), (bx, bz) in zip(ring, ring[1:] + ring[:1]):
        if (az > z) != (bz > z) and x < ax + (z - az) * (bx - ax) / (bz - az):
            found = not found
    return found


def test_clipped_areas_equal_counted_cells(spark):
    """Rings with whole corners and slopes of one: areas by counting points of a fine grid that lie on no side."""
    shapes = {1: [(0, 0), (9, 0), (9, 4), (4, 4), (4, 9), (0, 9)], 2: [(-5, 0), (0, 5), (5, 0), (0, -5)], 3: [(0, 0), (10, 0), (10, 10), (5, 5), (0, 10)], 4: [(2, 2), (2, 2), (2, 2)], 5: [(0, 0), (1, 1)], 6: []}
    table = spark.createDataFrame([(k, [(float(x), float(z)) for x, z in v]) for k, v in shapes.items()], RING)
    plan = polygons.tile_plan(table, "fid", 4, 1).collect()
    got = {(r.fid, r.tx, r.tz): r.area for r in plan}
    want = {}
    for fid, ring in shapes.items():
        for i in range(-40, 80):
            for j in range(-40, 80):
                for dx, dz in ((0.25, 0.5), (0.75, 0.5)):  # the two halves of a quarter cell along either diagonal
                    x, z = i / 4 + dx / 4, j / 4 + (dz if dx < 0.5 else 0.5) / 4
                    if _inside(ring, x, z):
                        key = (fid, i // 16, j // 16)
                        want[key] = want.get(key, 0) + 1 / 32
    assert set(got) == set(want)
    for key, area in got.items():
        assert abs(area - want[key]) < 0.6, (key, area, want[key])
    assert {f: sum(a for k, a in got.items() if k[0] == f) for f in (1, 2, 3)} == {1: 56.0, 2: 50.0, 3: 75.0}
    one = next(r for r in plan if (r.fid, r.tx, r.tz) == (1, 1, 0))
    assert (one.bounds, one.offset, one.priority) == ([3, -1, 9, 5], [4, 0], 2.5)


def test_clip_keeps_what_lies_on_a_side(spark):
    box = [F.lit(float(v)) for v in (0, 0, 2, 2)]
    rows = spark.createDataFrame([(1, [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]), (2, [(2.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0)]), (3, [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0)]), (4, [(-9.0, -9.0), (9.0, -9.0), (9.0, 9.0), (-9.0, 9.0)])], RING)
    cut = {r.fid: (r.ring, r.area) for r in rows.withColumn("ring", polygons.clip(F.col("ring"), *box)).withColumn("area", polygons.open_area(F.col("ring"))).collect()}
    assert [len(cut[k][0]) for k in (1, 3)] == [4, 0]
    assert [cut[k][1] for k in (1, 2, 3, 4)] == [4.0, 0.0, 0.0, 4.0]


def _touches(seg, cx, cz, s):
    ax, az, bx, bz = seg
    if cx * s > max(ax, bx) or (cx + 1) * s < min(ax, bx) or cz * s > max(az, bz) or (cz + 1) * s < min(az, bz):
        return False
    sides = [(bx - ax) * (z - az) - (bz - az) * (x - ax) for x in (cx * s, (cx + 1) * s) for z in (cz * s, (cz + 1) * s)]
    return min(sides) <= 0 <= max(sides)


def test_supercover_equals_a_test_of_every_cell(spark):
    r = random.Random(31)
    segments = [(r.randrange(-30, 30), r.randrange(-30, 30), r.randrange(-30, 30), r.randrange(-30, 30)) for _ in range(150)]
    segments += [(0, 0, 0, 0), (3, 3, 3, 3), (0, 0, 14, 14), (0, 0, 14, 0), (7, -9, 7, 20), (-7, 7, 7, -7), (1, 1, 1, 6)]
    table = spark.createDataFrame([(i, *s) for i, s in enumerate(segments)], "id int, ax long, az long, bx long, bz long")
    got = [tuple(x) for x in polygons.supercover(table, "id", 7).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(i, cx, cz) for i, s in enumerate(segments) for cx in range(-7, 7) for cz in range(-7, 7) if _touches(s, cx, cz, 7)}


def test_scan_rows_equal_the_test_of_each_cell(spark):
    r = random.Random(11)
    shapes = []
    for k in range(40):
        step = 0.5 if k % 2 else 0.01
        ring = lambda: [(r.randrange(int(-9 / step), int(9 / step)) * step, r.randrange(int(-9 / step), int(9 / step)) * step) for _ in range(r.randrange(3, 7))]
        shapes.append((k, [[*p, p[0]] for p in (ring() for _ in range(1 + k % 3))]))
    table = spark.createDataFrame([*shapes, (40, []), (41, None)], "k int, rings array<array<struct<x:double,z:double>>>")
    got = {(c.k, c.x, c.z) for c in polygons.scan_cells(table).collect()}
    grid = table.where("size(rings) > 0").select("k", "rings", F.explode(F.sequence(F.lit(-10), F.lit(10))).alias("x")).select("*", F.explode(F.sequence(F.lit(-10), F.lit(10))).alias("z"))
    held = polygons.inside(F.col("rings"), F.col("x") + 0.5, F.col("z") + 0.5) | (polygons.ring_distance2(F.col("rings"), F.col("x") + 0.5, F.col("z") + 0.5) < 1e-24)
    assert got == {(c.k, c.x, c.z) for c in grid.where(held).collect()} and len(got) > 1000
