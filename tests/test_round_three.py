"""Queries against their SQL on tables made to show one fault each."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import planes, polygons, ranges
from gridloom.plans import registry
from gridloom.sources import readers


def equal_to_sql(spark, folder, name, **tables):
    """The query's rows and those of its SQL on these tables, compared as bags."""
    con = duckdb.connect()
    for t, rows in tables.items():
        rows.to_parquet(f"{folder}/{t}.parquet", index=False)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = registry.QUERIES[name](spark, str(folder))
    want = con.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda found, names: sorted(str(tuple(r[names.index(c)] for c in sorted(names))) for r in found)
    left, right = rows(got.collect(), got.columns), rows(want.fetchall(), want.columns)
    assert left == right
    return len(left)


@pytest.mark.parametrize("name", ["f2_colour_parse", "f3_lightness", "j22_nearest_colour"])
def test_bands_are_single_precision(spark, tmp_path, name):
    """Components just below a whole number of sixtieths, where double and single precision have another floor."""
    near = (np.arange(90, 150) / 60 - 2).astype(np.float32)
    values = np.concatenate([np.nextafter(near, np.float32(-9)), near, np.nextafter(near, np.float32(9))])
    table = pd.DataFrame({"vec_id": np.arange(len(values)), "embedding": [np.full(4, v, np.float32) for v in values], "label": 0})
    assert equal_to_sql(spark, tmp_path, name, embeddings=table) > 0


def test_positions_on_the_border_of_a_page(spark, tmp_path):
    """Customer keys whose position lies on a page's west side."""
    k = np.arange(1, 20481)
    table = pd.DataFrame({"c_custkey": k, "c_name": "n", "c_mktsegment": "BUILDING"})
    assert equal_to_sql(spark, tmp_path, "f13_page_manifests", customer=table) > 0


def parts(copies):
    """Footprints of 60 boxes, each `copies` times under keys that give the same box and shape (30720 is a common period)."""
    k = np.concatenate([np.arange(1, 61) + 30720 * i for i in range(copies)])
    return pd.DataFrame({"p_partkey": k, "p_size": (k % 30720 % 50).astype(np.int32), "p_type": "ECONOMY", "p_brand": "b"})


def lines(n):
    k = np.arange(n)
    # orders and parts chosen so that points fall near the footprints of the first keys
    return pd.DataFrame({"l_orderkey": k * 31, "l_linenumber": (k % 7).astype(np.int32), "l_partkey": k * 17, "l_suppkey": k % 10, "l_quantity": (k % 50 + 1).astype(float), "l_extendedprice": k + 0.5, "l_returnflag": "A", "l_linestatus": "F"})


@pytest.mark.parametrize("name", ["a3_footprint_heights", "j13_point_in_polygon", "j13_associated_points", "j14_rasterise", "j16_roof_context", "j18_conflation", "f21_roof_gates", "j5_polygon_crop"])
def test_copies_of_boxes_equal_the_sql(spark, tmp_path, name):
    assert equal_to_sql(spark, tmp_path, name, part=parts(4), lineitem=lines(9000)) > 0


@pytest.mark.parametrize("name", ["j13_associated_points", "j13_point_in_polygon", "a3_footprint_heights", "j21_nearest_within", "j10_overlap_pair", "a26_kerb_profiles"])
def test_no_side_in_bins_is_broadcast(spark, name):
    """A file of boxes of some MB was broadcast after it was exploded into bins with its rings."""
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_box_counts_equal_a_plain_count(spark):
    """Boxes over several tiles, negative places, many levels, boxes without cells, boxes twice."""
    r = np.random.default_rng(5)
    cells = pd.DataFrame({"x": r.integers(-40, 40, 900), "z": r.integers(-40, 40, 900), "level": r.integers(-3, 200, 900), "n": 1}).groupby(["x", "z", "level"], as_index=False).sum()
    low = r.integers(-50, 40, (60, 2))
    boxes = pd.DataFrame(np.hstack([low, low + r.integers(1, 45, (60, 2))]), columns=ranges.BOX)
    boxes = pd.concat([boxes, boxes[:5]])
    got = ranges.box_counts(spark.createDataFrame(boxes), spark.createDataFrame(cells), 16).groupBy(*ranges.BOX, "level").agg(F.sum("n").alias("n")).collect()
    want = {}
    for b in set(map(tuple, boxes.to_numpy().tolist())):
        held = cells[(cells.x >= b[0]) & (cells.x < b[2]) & (cells.z >= b[1]) & (cells.z < b[3])].groupby("level").n.sum()
        want |= {(*b, int(k)): int(v) for k, v in held.items()}
    assert {tuple(g)[:5]: g.n for g in got} == want and len(got) == len(want)


def test_rasterise_equals_the_test_of_each_cell(spark):
    r = np.random.default_rng(8)
    rings = [(r.integers(-16, 17, (3 + k % 4, 2)) / 2).tolist() for k in range(40)]
    shapes = [(k, [[tuple(p) for p in [*ring, ring[0]]]]) for k, ring in enumerate(rings)]
    table = spark.createDataFrame([*shapes, (40, [])], "k int, rings array<array<struct<x:double,z:double>>>").select("*", *(F.lit(float(v)).alias(c) for c, v in zip(ranges.BOX, (-9, -9, 9, 9), strict=True)))
    got = [tuple(c) for c in polygons.rasterise(table, "k").collect()]
    grid = table.withColumn("x", F.explode(F.sequence(F.lit(-9), F.lit(8)))).withColumn("z", F.explode(F.sequence(F.lit(-9), F.lit(8))))
    want = grid.where(polygons.inside(F.col("rings"), F.col("x") + 0.5, F.col("z") + 0.5)).select("k", "x", "z").collect()
    assert sorted(got) == sorted(map(tuple, want)) and len(got) > 500


def test_roof_cells_need_no_aggregate(spark):
    """Cells were summed in a hash table beside the shuffle of faces, whose size grew with the faces of a task."""
    face = "k int, rings array<array<struct<x:double,y:double,z:double>>>, plane struct<slope_x:double,slope_z:double,x:double,y:double,z:double>, fault string"
    box = [(0.0, 0.0, 0.0), (4.0, 0.0, 0.0), (4.0, 0.0, 3.0), (0.0, 0.0, 3.0), (0.0, 0.0, 0.0)]
    out = planes.heights(spark.createDataFrame([(1, [box], (0.0, 0.0, 0.0, 5.5, 0.0), None), (1, [box], (1.0, 0.0, 0.0, 4.0, 0.0), None)], face), "k")
    assert {(c.x, c.z): c.top for c in out.collect()} == {(x, z): max(5, 4 + x) for x in range(4) for z in range(3)}
    assert "[k#" in (plan := out._jdf.queryExecution().optimizedPlan().toString()) and plan.count("Aggregate") == 1 and "Window" not in plan


def test_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "PLACEMARKS", 100)
    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(z).alias("lat")) for x, z in ((0, 0), (1, 0), (1, 1), (0, 0))))
    readers.write_placemarks(spark.range(950).coalesce(1).select("id", F.lit(None).cast("string").alias("name"), F.lit(3.0).alias("height"), ring.alias("ring")), f"{tmp_path}/xml")
    assert readers.placemarks(spark, f"{tmp_path}/xml").count() == 950
    assert len([f for f in (tmp_path / "xml").iterdir() if f.name.startswith("part-")]) == 10
