"""Kerbs against a plain walk along each way."""

import random
from math import floor, hypot, isnan, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import profiles

WAY = "way int, path array<struct<x:double,z:double>>"
CELL = "cx long, cz long, h double, stop boolean"


def plain(path, cells, cell):
    """side -> (samples, detections, kerb, iqr) of one way."""
    legs = [(p, q, hypot(q[0] - p[0], q[1] - p[1])) for p, q in zip(path, path[1:]) if p != q]
    length = sum(g[2] for g in legs)
    if length < 4:
        return {}

    def at(d):
        for p, q, n in legs:
            if d <= n or (p, q, n) == legs[-1]:
                return p[0] + (q[0] - p[0]) * d / n, p[1] + (q[1] - p[1]) * d / n
            d -= n

    result = {}
    for side in (1, -1):
        rises, tried = [], 0
        for d in np.arange(1.0, length - 1, 2.0):
            x, z = at(d)
            (ax, az), (bx, bz) = at(max(0, d - 1)), at(min(length, d + 1))
            n = hypot(bx - ax, bz - az)
            if not n:
                continue
            tried += 1
            line = [cells.get((floor((x - (bz - az) / n * side * t) / cell), floor((z + (bx - ax) / n * side * t) / cell)), (nan, False)) for t in np.arange(0.5, 18, 0.5)]
            heights = [nan if h is None else h for h, _ in line]
            end = next((i for i, s in enumerate(line) if s[1]), len(line))
            for i in range(3, end - 3):
                low = np.nanmin(heights[i - 2 : i + 1]) if not isnan(heights[i]) else nan
                if heights[i + 2] - low >= 0.08 and heights[i + 3] - low >= 0.08:
                    rises.append((i + 2) * 0.5)
                    break
        if tried:
            q = np.percentile(rises, [25, 50, 75]) if rises else None
            result[side] = (tried, len(rises), float(q[1]) if len(rises) >= max(3, tried / 4) else None, float(q[2] - q[0]) if len(rises) >= 3 else None)
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_kerbs_equal_a_plain_walk(spark, seed):
    """Bent ways over a bumpy street with gaps, NaN and stops."""
    r = random.Random(seed)
    ways = []
    for k in range(14):
        path = [(40 * k + r.uniform(5, 9), r.uniform(20, 24))]
        for _ in range(r.randrange(1, 5)):
            path.append((path[-1][0] + r.uniform(1, 9), path[-1][1] + r.uniform(-6, 6)))
        ways.append((k, path if k % 4 else [path[0], *path]))
    ways += [(14, [(3.0, 3.0), (5.0, 4.0)]), (15, [(3.0, 3.0)]), (16, []), (17, None), (18, [(3.0, 3.0)] * 3), (19, [(600.3, 20.2), (620.3, 20.2), (600.3, 20.2)])]
    cells = {}
    for cx in range(0, 1300):
        for cz in range(0, 100):
            if r.random() > 0.03:
                kerb = 0.2 if abs(cz - 44) > 10 + cx // 80 % 9 else 0.0
                cells[cx, cz] = (None if r.random() < 0.02 else nan if r.random() < 0.02 else kerb + r.choice((0, 0, 0, 0.03, 0.09)), r.random() < 0.004)
    table = spark.createDataFrame([(x, z, h, s) for (x, z), (h, s) in cells.items()], CELL)
    got = {(g.way, g.side): (g.samples, g.detections, g.kerb, g.iqr) for g in profiles.kerbs(spark.createDataFrame(ways, WAY), "way", table, 0.5).collect()}
    want = {(k, side): v for k, path in ways if path for side, v in plain(path, cells, 0.5).items()}
    assert got == want
    assert sum(v[2] is not None for v in got.values()) > 8


def test_planted_kerb_stop_and_fallback(spark):
    """One side: samples from 5.5 m on are raised, so the kerb is at the one before, 5 m. Other side: a kerb beyond a stop."""
    cells = [(x, z, 0.15 if z <= -6 or z >= 5 else 0.0, z == 3) for x in range(30) for z in range(-20, 20)]
    ways = spark.createDataFrame([(1, [(0.25, 0.25), (29.25, 0.25)]), (2, [(500.0, 0.0), (520.0, 0.0)])], WAY)
    found = profiles.kerbs(ways, "way", spark.createDataFrame(cells, CELL), 1.0)
    rows = {(k.way, k.side): (k.samples, k.detections, k.kerb) for k in found.collect()}
    assert rows == {(1, 1): (14, 0, None), (1, -1): (14, 14, 5.0), (2, 1): (9, 0, None), (2, -1): (9, 0, None)}
    guess = F.struct(F.when(F.col("way") == 1, 4.0).otherwise(3.2).alias("value"), F.lit("lanes").alias("how"))
    sides = {(c.way, c.side): (c.half, c.how) for c in profiles.carriageway(ways, "way", found, guess).collect()}
    assert sides == {(1, 1): (4.0, "lanes"), (1, -1): (5.0, "kerb profile"), (2, 1): (3.2, "lanes"), (2, -1): (3.2, "lanes")}
    for value, half in ((2.4, 4.0), (2.5, 2.5), (10.0, 10.0), (10.1, 4.0)):
        measured = spark.createDataFrame([(1, 1, value)], "way int, side int, kerb double")
        assert {c.half for c in profiles.carriageway(ways.where("way = 1"), "way", measured, guess).where("side = 1").collect()} == {half}
    assert profiles.kerbs(ways.limit(0), "way", spark.createDataFrame(cells, CELL), 1.0).count() == 0
