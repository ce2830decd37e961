"""Single operators on small tables with known results."""


import pytest
from pyspark.sql import functions as F

from gridloom.functions import attributes, frame, keys, times
from gridloom.operators import focal, graph, merges, polygons, ranges, rasters
from gridloom.plans import registry

# Block x, z and the geographic position, from a projection library.
PLACES = [(32.0, 33.0, -87.62443, 41.8972), (0.0, 0.0, -87.62481561839934, 41.897497105830666), (-67072.0, 38400.0, -88.42871029316771, 41.54895005423546), (90000.0, -90000.0, -86.52637164908018, 42.70246652272788), (1000.0, 120000.0, -87.61295638056826, 40.81700752458575)]


def test_frame_matches_known_places(spark):
    df = spark.createDataFrame(PLACES, "x double, z double, lon double, lat double")
    bx, bz = frame.to_block(F.col("lon"), F.col("lat"))
    lon, lat = frame.to_geographic(F.col("x"), F.col("z"))
    for r in df.select("*", bx.alias("bx"), bz.alias("bz"), lon.alias("lo"), lat.alias("la")).collect():
        assert abs(r.bx - r.x) < 0.02 and abs(r.bz - r.z) < 0.02
        assert abs(r.lo - r.lon) < 2e-7 and abs(r.la - r.lat) < 2e-7


def test_keys_floor_negatives_and_bits_round_trip(spark):
    r = spark.range(1).select(keys.chunk(F.lit(-1)).alias("c"), keys.region(F.lit(-513)).alias("r"), keys.chunk_slot(F.lit(-1), F.lit(-1)).alias("s"), keys.unpack_bits(keys.pack_bits(F.array(*map(F.lit, range(20))), 5), 5, 20).alias("v")).first()
    assert (r.c, r.r, r.s) == (-1, -2, 31 + 31 * 32) and list(r.v) == list(range(20))


def test_attributes(spark):
    df = spark.createDataFrame([("12 m",), ("7.5metres",), ("12 ft",), (None,), ("",)], "v string")
    assert [r[0] for r in df.select(attributes.metres(F.col("v"))).collect()] == [12.0, 7.5, None, None, None]
    c = spark.createDataFrame([("#fff",), ("#102030",), ("Dark Grey",), ("#12",), (None,)], "v string")
    assert [r[0] for r in c.select(attributes.colour(F.col("v"))).collect()] == [[255] * 3, [16, 32, 48], [70] * 3, None, None]
    first, last = times.interval(F.col("v"))
    i = spark.createDataFrame([("2020",), ("2020-02",), ("2020-02-03",), ("x",)], "v string").select(first.alias("a"), last.alias("b")).collect()
    assert [(str(r.a), str(r.b)) for r in i] == [("2020-01-01", "2020-12-31"), ("2020-02-01", "2020-02-29"), ("2020-02-03", "2020-02-03"), ("None", "None")]


def test_surfaces_and_gap_fill(spark):
    rows = [(15, 15, 100, 2), (15, 15, 110, 6), (3, 3, 118, 5), (3, 3, 100, 2)]
    s = rasters.surfaces(spark.createDataFrame(rows, "x long, z long, y long, cls int"), ["x", "z"], "y").orderBy("x").collect()
    assert (s[0].dsm, s[0].ground_sum) == (100, 100)  # trees never lift the surface
    assert (s[1].dsm, s[1].n_ground) == (110, 1)
    ring = spark.createDataFrame([(x, z, 107) for x in range(3) for z in range(3) if (x, z) != (1, 1)], "x long, z long, dsm long")
    filled = rasters.fill_highest(ring, spark.createDataFrame([(1, 1), (9, 9)], "x long, z long"), "dsm").orderBy("x").collect()
    assert [(r.dsm, r.filled) for r in filled] == [(107, True), (None, True)]


def test_range_join_finds_each_pair_once(spark):
    a = spark.createDataFrame([(1, 0, 0, 100, 100), (2, -50, -50, -10, -10)], "id long, x0 long, z0 long, x1 long, z1 long")
    b = spark.createDataFrame([(7, 99, 99, 300, 300), (8, 100, 0, 120, 20), (9, -20, -20, 10, 10)], "id long, x0 long, z0 long, x1 long, z1 long")
    for size in (8, 64, 1000):
        got = sorted((r.id, r.r_id) for r in ranges.range_join(a, b, size).collect())
        assert got == [(1, 7), (1, 9), (2, 9)]
    assert sorted((r.id, r.r_id) for r in ranges.range_join(a, b, 16, pad=1).collect()) == [(1, 7), (1, 8), (1, 9), (2, 9)]


def test_polygons_with_holes_and_rings(spark):
    box = polygons.box_ring(F.lit(0), F.lit(0), F.lit(10), F.lit(10))
    hole = polygons.box_ring(F.lit(4), F.lit(4), F.lit(6), F.lit(6))
    shape = spark.range(1).select(F.col("id").alias("fid"), F.array(box, hole).alias("rings"), F.lit(0).alias("x0"), F.lit(0).alias("z0"), F.lit(10).alias("x1"), F.lit(10).alias("z1"))
    assert polygons.rasterise(shape, "fid").count() == 96
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 10.5, 5.0), (4, 12.0, 5.0)], "pid long, x double, z double")
    got = {r.pid: r.core for r in polygons.associate(points, shape, "fid").collect()}
    assert got == {1: False, 2: True, 3: False}
    ways = spark.createDataFrame([(1, [1, 2, 3, 1]), (2, [1, 2, 9, 1])], "way long, nodes array<long>")
    nodes = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 1)], "node long, x long, z long")
    assert [r.way for r in polygons.assemble_rings(ways, nodes).collect()] == [1]


def test_focal_results_do_not_depend_on_the_tile(spark):
    cells = spark.range(900).select((F.col("id") % 30 - 15).alias("x"), (F.floor(F.col("id") / 30) - 15).alias("z"), ((F.col("id") * 7919) % 97).alias("v")).where("v % 5 <> 0")
    a, b = (sorted(map(tuple, focal.tiled(cells, "v", t, 3, focal.window_median(3), "m").collect())) for t in (8, 64))
    assert a == b and len(a) == cells.count()


def test_edits_in_order(spark):
    blocks = spark.createDataFrame([(0, 70, 0, "grass"), (1, 70, 0, "stone")], "x long, y long, z long, state string")
    first = spark.createDataFrame([(0, 70, 0, "farmland", "grass"), (0, 71, 0, "wheat", None), (1, 70, 0, "concrete", "grass")], "x long, y long, z long, state string, expect string")
    second = spark.createDataFrame([(0, 70, 0, "path", "farmland")], "x long, y long, z long, state string, expect string")
    out, judged = merges.apply_layers(blocks, [first, second], ["x", "y", "z"])
    assert {(r.x, r.y): r.state for r in out.collect()} == {(0, 70): "path", (0, 71): "wheat", (1, 70): "stone"}
    assert sorted(r.outcome for r in judged.collect()) == ["applied", "applied", "applied", "precondition_failed"]


def test_components_and_suppression(spark):
    cells = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (5, 5), (6, 6), (-3, 0)], "x long, z long")
    assert graph.cell_components(cells, rasters.SIDES).select("label").distinct().count() == 4
    assert graph.cell_components(cells, [o for o in rasters.square(1) if o != (0, 0)]).select("label").distinct().count() == 3
    chain = spark.createDataFrame([(k, 10 - k) for k in range(8)], "id long, score long")
    conflicts = spark.createDataFrame([(k, k + 1) for k in range(7)], "a long, b long")
    assert sorted(r.id for r in graph.suppress(chain, conflicts, [-F.col("score")]).collect()) == [0, 2, 4, 6]
    reach = graph.reach(cells.where("x = 0"), cells, rasters.SIDES, 7)
    assert {(r.x, r.z): r.step for r in reach.collect()} == {(0, 0): 0, (1, 0): 1, (1, 1): 2}


def test_lease_fencing(spark):
    from gridloom.plans.registry import QUERIES

    rows = QUERIES["r4_lease_state"](spark, "/root/testdata/sf0.001").collect()
    assert {r.outcome for r in rows} <= {"claimed", "renewed", "completed", "rejected"}
    assert len({r.event_id for r in rows}) == len(rows)


def test_crowns_do_not_depend_on_the_tile(spark):
    import numpy as np

    from gridloom.operators import crowns

    dome = lambda r, x, z, h: np.maximum(0, h - np.hypot(np.arange(40)[:, None] - z, np.arange(40)[None, :] - x) * h / r)
    canopy = np.maximum(dome(5, 12, 12, 12), dome(4, 25, 12, 8))
    canopy[canopy < 2] = np.nan
    tops = crowns.local_tops(canopy, 4)
    assert tops.tolist() == [[12, 12], [12, 25]]
    label = crowns.grow(canopy, tops, 6)
    assert label[12, 13] == 0 and label[12, 24] == 1 and label[30, 30] == -1
    rows = [(int(x), int(z), float(canopy[z, x])) for z in range(40) for x in range(40) if canopy[z, x] > 0]
    cells = spark.createDataFrame(rows, "x long, z long, top double")
    a, b = (sorted(map(tuple, crowns.segment(cells, "top", 2, 5, t).collect())) for t in (17, 64))
    assert a == b and {c for *_, c in a} == {12 * crowns.SPAN + 12, 25 * crowns.SPAN + 12}
