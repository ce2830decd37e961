"""Coverage, pieces, roof gates and attribute rules on small hand-made tables."""

from pyspark.sql import functions as F

from gridloom.functions import attributes
from gridloom.operators import coverage, graph, polygons
from gridloom.sources import readers


def test_overlapping_surveys_count_once(spark):
    tiles = spark.createDataFrame([(0, 0), (5, 5)], "tx long, tz long")
    surveys = spark.createDataFrame([(0, 0, 2, 4, True), (1, 0, 3, 4, False), (4, 0, 5, 1, True)], "x0 long, z0 long, x1 long, z1 long, asset boolean")
    rows = {(r.tx, r.tz): r for r in coverage.tile_coverage(tiles, surveys, 4, 1).collect()}
    r = rows[0, 0]
    assert (r.surveys, r.missing, r.core_indexed, r.core_available) == (3, 1, 12 / 16, 8 / 16)
    assert r.halo_indexed == 13 / 36
    assert tuple(rows[5, 5])[2:] == (0, 0, 0.0, 0.0, 0.0)


def test_pieces_stop_at_barriers_and_tiles(spark):
    cells = spark.createDataFrame([(0, 0, 0, 0, 5), (0, 0, 0, 1, 1), (0, 0, 0, 3, 1), (0, 1, 0, 4, 5), (0, 1, 0, 5, 7)], "tx long, tz long, x long, z long, n long")
    out = graph.seeded_pieces(cells, ["tx", "tz"], F.col("n") == 5, F.col("n") == 7)
    assert sorted(map(tuple, out.collect())) == [(0, 0, 0, 0, 2, False), (0, 1, 0, 4, 2, True)]


def test_fragments_that_float(spark):
    v = "x long, y long, z long"
    voxels = spark.createDataFrame([(0, 5, 0), (1, 6, 1), (9, 5, 9), (20, 5, 20)], v)
    out = graph.floating(voxels, spark.createDataFrame([(9, 4, 9)], v), spark.createDataFrame([(21, 6, 21)], v))
    assert [(r.cells, r.low) for r in out.collect()] == [(2, 5)]
    assert graph.floating(voxels, spark.createDataFrame([], v), spark.createDataFrame([], v), most=1).count() == 2


def test_roof_gates(spark):
    c = "fid long, x long, z long"
    mask = spark.createDataFrame([(1, i, 0) for i in range(10)] + [(2, 0, 0), (3, 0, 0)], c)
    model = spark.createDataFrame([(1, i, 0, 8.0) for i in range(1, 10)] + [(3, 0, 0, 8.5)], c + ", top double")
    provider = spark.createDataFrame([(1, 9), (2, 9), (3, 9)], "fid long, height long")
    out = {r.fid: r for r in polygons.roof_gates(mask, model, provider, "fid").collect()}
    assert out[1].accepted and out[1].coverage == 0.9 and out[1].residual == -1.0
    assert not out[2].accepted and not out[3].accepted


def test_attribute_rules(spark):
    df = spark.createDataFrame([("Café --  Straße", "A_D18_x", {"width": "wide", "oneway": "yes"}), (None, "A_LAS_2019_2017", {"width": "7 m"}), ("", "B", {"lanes": "4", "highway": "primary"})], "t string, n string, tags map<string,string>")
    h = attributes.half_width(F.col("tags"))
    rows = df.select(attributes.fold_text("t"), attributes.year_in_name(F.col("n")), F.round(h["value"], 3), h["how"]).collect()
    assert [tuple(r) for r in rows] == [("cafe strasse", 2018, 2.8, "lanes"), (None, 2017, 3.5, "width tag"), ("", None, 6.4, "lanes")]
    wall = spark.createDataFrame([(10, 10, 10), (180, 120, 60), (200, 200, 200)], "r int, g int, b int")
    got = [r[0] for r in wall.select(attributes.window_glass(F.col("r"), F.col("g"), F.col("b"))).collect()]
    assert got == list(attributes.GLASS.values())


def test_placemarks_need_height_and_a_closed_ring(spark, tmp_path):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    rows = [(1, "a <b> & c", 4.0, ring), (2, None, 0.0, ring), (3, None, 3.0, ring[:3]), (4, None, 5.0, ring), (5, None, None, ring)]
    df = spark.createDataFrame(rows, "id long, name string, height double, ring array<struct<lon: double, lat: double>>")
    readers.write_placemarks(df, str(tmp_path / "x"))
    out = sorted((r.name, r.data["height_m"]) for r in readers.placemarks(spark, str(tmp_path / "x")).collect())
    assert out == [("a <b> & c", "4.0"), ("way 4", "5.0")]
