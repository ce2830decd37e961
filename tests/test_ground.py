"""Ground rules, specks, holes and the nearest-value transform."""

import random

import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import focal, ground

CELL = "x long, z long, red long, green long, blue long, nir long, visible boolean, cover int, parking boolean, wetland boolean, editable boolean"


def test_each_rule_and_their_order(spark):
    pale, dark, earth, lush, none = (180, 180, 180, 150), (110, 110, 115, 100), (150, 120, 100, 150), (60, 90, 60, 200), (0, 0, 0, 0)
    cases = [
        (pale, True, None, False, False, True, "concrete"), (dark, True, None, False, False, True, "asphalt"), (earth, True, None, False, False, True, "soil"),
        (lush, True, None, True, False, True, "keep"), (earth, True, None, True, False, True, "asphalt"), (lush, True, 40, False, False, True, "field"), (pale, True, 40, False, False, True, "concrete"),
        (lush, True, 30, False, False, True, "prairie"), (lush, True, 30, True, False, True, "keep"), (lush, True, 90, False, False, True, "marsh"), (earth, True, None, False, True, True, "mud"),
        (pale, False, None, False, False, True, "keep"), (pale, None, None, False, False, True, "keep"), (pale, True, None, False, False, False, "keep"), (none, True, 40, False, False, True, "keep"), (pale, True, None, None, None, None, "keep"),
    ]
    rows = [(i, 0, *bands, visible, cover, parking, wetland, editable) for i, (bands, visible, cover, parking, wetland, editable, _) in enumerate(cases)]
    found = {r.x: r["class"] for r in ground.classified(spark.createDataFrame(rows, CELL)).collect()}
    assert found == {i: c[-1] for i, c in enumerate(cases)}


def test_specks_go_by_class(spark):
    rows = [(x, 0, "concrete") for x in range(3)] + [(x, 2, "concrete") for x in range(2)] + [(x, 1, "asphalt") for x in range(11)] + [(x, 5, "asphalt") for x in range(12)] + [(0, 9, "keep")]
    kept = {(r.x, r.z): r["class"] for r in ground.without_specks(spark.createDataFrame(rows, "x long, z long, class string")).collect()}
    assert all(kept[x, 0] == "concrete" for x in range(3)) and all(kept[x, 2] == "keep" for x in range(2))
    assert all(kept[x, 1] == "keep" for x in range(11)) and all(kept[x, 5] == "asphalt" for x in range(12)) and len(kept) == len(rows)


def test_holes_in_paving(spark):
    """An asphalt yard with a dull hole, a green island, a shaded hole and a hole that is open to the lawn."""
    cells = {(x, z): ["keep", 0.6, True] for x in range(30) for z in range(30)}
    cells |= {(x, z): ["asphalt" if x < 15 else "concrete", 0.0, True] for x in range(5, 25) for z in range(5, 25)}
    for x, z, index, lit in ((8, 8, 0.1, True), (9, 8, 0.1, True), (20, 8, 0.55, True), (8, 20, 0.1, False), (20, 20, 0.1, True), (5, 15, 0.1, True)):
        cells[x, z] = ["keep", index, lit]
    table = spark.createDataFrame([(x, z, c, i, s, True, True) for (x, z), (c, i, s) in cells.items()], "x long, z long, class string, index double, sunlit boolean, visible boolean, editable boolean")
    found = {(r.x, r.z): r["class"] for r in ground.without_holes(table, 64).collect()}
    changed = {k: v for k, v in found.items() if v != cells[k][0]}
    assert changed == {(8, 8): "asphalt", (9, 8): "asphalt", (20, 20): "concrete"} and len(found) == len(cells)


def test_nearest_value_equals_all_pairs_whatever_the_tile(spark):
    r = random.Random(6)
    cells = [(x, z, float(r.randrange(1000)) if r.random() < 0.04 else None) for x in range(-20, 40) for z in range(-20, 40)]
    table = spark.createDataFrame(cells, "x long, z long, v double")
    known = [c for c in cells if c[2] is not None]
    want = {}
    for x, z, _ in cells:
        best = min(((x - a) ** 2 + (z - b) ** 2, b, a, v) for a, b, v in known)
        if best[0] <= 81:
            want[x, z] = best[3]
    for tile in (9, 16, 64):
        got = {(c.x, c.z): c.f for c in focal.tiled(table, "v", tile, 9, focal.nearest_value(9), "f").where(F.col("f").isNotNull()).collect()}
        assert got == want
    grid = np.full((3, 3), np.nan)
    assert np.isnan(focal.nearest_value(5)(grid)).all()
