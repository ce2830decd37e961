"""Whole-Earth pages."""

from pyspark.sql import functions as F

from gridloom.functions import atlas


def test_every_position_has_one_page(spark):
    rows = [(10.0, -90.0), (-140.0, -90.0), (10.0, 90.0), (-140.0, 90.0), (180.0, 5.0), (-180.0, 5.0), (179.999, 0.0), (-179.999, 0.0), (0.0, 91.0)]
    band, column = atlas.page(F.col("lon"), F.col("lat"))
    got = [(r.b, r.c) for r in spark.createDataFrame(rows, "lon double, lat double").select(band.alias("b"), column.alias("c")).collect()]
    assert got[0] == got[1] == (0, got[0][1]) and got[2] == got[3] == (atlas.BANDS - 1, got[2][1])
    assert got[4] == got[5] and got[6] != got[7] and got[8][0] is None


def test_meridian_series_round_trip(spark):
    lat = F.col("id") / 10 - 90
    worst = spark.range(1801).select(F.max(F.abs(atlas.latitude_at(atlas.meridian_distance(lat)) - lat))).first()[0]
    assert worst < 1e-8
    assert 1_000_000 < spark.range(atlas.BANDS).select(F.sum(atlas.columns_in(F.col("id")))).first()[0] < 2_500_000


def test_manifests_cover_every_band_within_the_budget(spark):
    bands = spark.range(0, atlas.BANDS, 7).select(F.col("id").alias("band"))
    pages = bands.select("band", F.explode(F.array(F.lit(0).cast("long"), atlas.columns_in(F.col("band")) - 1)).alias("column")).distinct()
    rows = atlas.page_manifests(pages).collect()
    assert len(rows) == pages.count()
    inner = [r for r in rows if 0 < r.band < atlas.BANDS - 1]
    assert all(r.fault is None and 0 < r.scale_ppm <= atlas.SCALE_BUDGET for r in inner)
    for r in inner:
        assert r.west % 256 == r.south % 256 == r.east % 256 == r.north % 256 == 0
        assert r.columns == (r.east - r.west) // 256 and r.rows == (r.north - r.south) // 256
        assert 60 <= r.rows <= 75 and r.west < -512 and r.east > 512
    assert {r.fault for r in rows if r.band == 0} == {"pole"}


def test_manifests_of_no_pages(spark):
    odd = spark.createDataFrame([(-1, 0), (atlas.BANDS, 0), (700, -1), (700, 10**7), (None, 3), (atlas.BANDS - 1, 0)], "band long, column long")
    assert [r.fault for r in atlas.page_manifests(odd).orderBy(F.col("band").asc_nulls_first(), "column").collect()] == ["outside", "outside", "outside", "outside", "pole", "outside"]
    assert atlas.page_manifests(odd.limit(0)).count() == 0


def test_scale_factor_is_the_ratio_of_lengths(spark):
    """Against small steps along a parallel, taken through the projection."""
    step = 1e-5
    at = spark.createDataFrame([(0.05, 10.0), (0.1, 45.0), (0.2, 70.0)], "lon double, lat double")
    place = lambda d: atlas.page_local(F.col("lon") + d, F.col("lat"), F.lit(0.0), F.col("lat"))
    (xa, za), (xb, zb) = place(-step), place(step)
    p = F.radians("lat")
    true = F.lit(2 * step * 3.141592653589793 / 180) * atlas.AXIS * F.cos(p) / F.sqrt(1 - atlas.E2 * F.pow(F.sin(p), 2))
    for r in at.select((F.sqrt(F.pow(xb - xa, 2) + F.pow(zb - za, 2)) / true).alias("got"), atlas.scale_factor(F.col("lon"), F.col("lat"), F.lit(0.0)).alias("want")).collect():
        assert abs(r.got - r.want) < 2e-8
