"""Kerbs across the borders of tiles, and what is shuffled for them: packed cells and stations, no row a sample or cell."""

import random
from math import nan

from gridloom.operators import profiles
from tests.test_profiles import CELL, WAY, plain


def test_profiles_cross_tiles(spark):
    r = random.Random(5)
    ways = [(k, [(256 * (k % 3 - 1) + r.uniform(-30, 30), 256 * (k // 3 - 1) + r.uniform(-4, 4))]) for k in range(9)]
    ways = [(k, [*p, (p[0][0] + r.uniform(20, 40), p[0][1] + r.uniform(-5, 5))]) for k, p in ways]
    cells = {}
    for _, ((x0, z0), (x1, _z)) in ways:
        for cx in range(int(x0) - 30, int(x1) + 30):
            for cz in range(int(z0) - 30, int(z0) + 30):
                cells[cx, cz] = (None if r.random() < 0.03 else nan if r.random() < 0.02 else 0.2 if abs(cz - z0) > 6 + cx % 3 else 0.0, r.random() < 0.004)
    rows = [(x, z, h, s or None) for (x, z), (h, s) in cells.items()] + [(None, 3, 1.0, True), (3, None, 1.0, True)]
    found = profiles.kerbs(spark.createDataFrame(ways, WAY), "way", spark.createDataFrame(rows, CELL), 1.0)
    got = {(g.way, g.side): (g.samples, g.detections, g.kerb, g.iqr) for g in found.collect()}
    assert got == {(k, side): v for k, path in ways for side, v in plain(path, cells, 1.0).items()}
    assert sum(v[2] is not None for v in got.values()) > 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and "SortMergeJoin" not in plan


def test_a_batch_is_a_row_a_tile(spark):
    cells = [(x, z, 1.0, False) for x in range(100) for z in range(100)]
    packed = profiles._packed(spark.createDataFrame(cells, CELL).coalesce(1), 256, 20).collect()
    assert len({(p.tx, p.tz) for p in packed}) == 4  # its own tile, and three whose halo holds the corner
    assert len(packed) <= 8 and sum(len(p.at) // 4 for p in packed if (p.tx, p.tz) == (0, 0)) == 10_000
