"""Readers on files that the tests write."""

import gzip
import json
import struct

import numpy as np
from pyspark.sql import functions as F

from gridloom.sources import readers


def test_json_sources(spark, tmp_path):
    (tmp_path / "ways.json").write_text("\n".join(json.dumps({"id": i, "tags": {"highway": "path"}, "coordinates": [[0.0, 0.0], [1.0, 1.0]], "closed": False}) for i in (20, 9)))
    assert [r.id for r in readers.ways(spark, str(tmp_path / "ways.json")).orderBy("seq").collect()] == [9, 20]
    ring = [{"lat": 0, "lon": 0}, {"lat": 0, "lon": 1}, {"lat": 1, "lon": 1}, {"lat": 0, "lon": 0}]
    elements = [{"type": "node", "id": 1, "lat": 0, "lon": 0, "tags": {"natural": "tree"}}, {"type": "node", "id": 2, "lat": 0, "lon": 0}, {"type": "way", "id": 3, "tags": {"building": "yes"}, "geometry": ring}, {"type": "way", "id": 4, "tags": {"highway": "path"}, "geometry": ring[:2]}]
    (tmp_path / "e.json").write_text(json.dumps({"elements": elements}))
    assert {r.id: r.kind for r in readers.typed_features(spark, str(tmp_path / "e.json")).collect()} == {1: "Point", 3: "Polygon", 4: "LineString"}
    feature = lambda i: {"id": i, "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}
    (tmp_path / "f.json").write_text(json.dumps({"features": [feature("a"), feature("b"), feature("b"), feature("")]}))
    found, faults = readers.feature_collection(spark, str(tmp_path / "f.json"))
    assert found.count() == 4 and {r.id for r in faults.collect()} == {"b", ""}
    (tmp_path / "log.txt").write_text('noise\n{"utc":"2024-01-01T00:00:00Z","event":"a"}\n{"utc":"2024-01-03T00:00:00Z","event":"b"}\n')
    assert [r.event for r in readers.event_log(spark, str(tmp_path / "log.txt"), "2024-01-02").collect()] == ["b"]
    (tmp_path / "h.json").write_text(json.dumps({"0-0-0-0": 10, "1-0-0-0": 5, "1-1-1-0": -1}))
    nodes = {r.key: r.page for r in readers.octree_nodes(spark, str(tmp_path / "h.json"), (0, 0, 100, 100), (0, 0, 40, 40)).collect()}
    assert nodes == {"0-0-0-0": False, "1-0-0-0": False}


def test_binary_sources(spark, tmp_path):
    a = np.zeros(3, readers.POINT)
    a["x"], a["cls"], a["flags"], a["returns"] = [1, -2, 3], [2, 6, 1], [0, 4, 0], [0x21, 0x11, 0x22]
    (tmp_path / "p.bin").write_bytes(a.tobytes())
    p = readers.point_records(spark, str(tmp_path / "p.bin")).orderBy("x").collect()
    assert [(r.x, r.cls, r.withheld, r.return_number, r.returns) for r in p] == [(-2, 6, True, 1, 1), (1, 2, False, 1, 2), (3, 1, False, 2, 2)]
    head = {"width": 2, "west": -87.0, "north": 41.0, "step": 0.5, "scale": 0.1}
    (tmp_path / "b.gz").write_bytes(gzip.compress(json.dumps(head).encode() + b"\n" + np.array([-500, -32768, 0, 7], "<i2").tobytes()))
    b = readers.bathymetry(spark, str(tmp_path / "b.gz")).orderBy("row", "col").collect()
    assert [r.value for r in b] == [-50.0, None, 0.0, 0.7000000000000001] and b[3].lat == 40.5
    body = struct.pack(">IB", 10, 2) + b"x" * 9
    header = bytearray(8192)
    header[0:4], header[4:8], header[8:12] = struct.pack(">I", 2 << 8 | 1), struct.pack(">I", 2 << 8 | 1), struct.pack(">I", 900 << 8 | 1)
    (tmp_path / "r.0.0.mca").write_bytes(bytes(header) + body.ljust(4096, b"\0"))
    c = readers.region_chunks(spark, str(tmp_path / "r.0.0.mca"))
    assert {r.slot: r.error for r in c.collect()} == {0: None, 1: "overlapping_sectors", 2: "outside_file"}
    assert [r.chunks for r in readers.region_index(c).collect()] == [1]
    assert readers.inventory(spark, str(tmp_path)).count() == 3


def test_edit_layer_round_trip(spark, tmp_path):
    edits = spark.createDataFrame([(0, 70, 0, "path"), (17, 71, -1, "stone"), (600, 5, 0, "path")], "x long, y long, z long, state string")
    manifest = readers.write_edit_layer(edits, str(tmp_path / "layer"))
    assert {(r.rx, r.rz): r.edits for r in manifest.collect()} == {(0, 0): 1, (0, -1): 1, (1, 0): 1}
    back = spark.read.json(str(tmp_path / "layer")).select(F.explode("edits").alias("e")).select("e.x", "e.y", "e.z", "e.state")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, edits.collect()))
    lines = [{"schema": "v1", "palette": ["a", "b"]}, {"cx": 0, "cz": 0, "x": [1, 2], "y": [3, 4], "z": [5, 6], "p": [0, 1], "s": [0, 0]}, {"cx": 1, "cz": 0, "x": [1], "y": [3, 4], "z": [5], "p": [0], "s": [0]}, {"cx": 2, "cz": 0, "x": [1], "y": [3], "z": [5], "p": [7], "s": [0]}]
    (tmp_path / "e.jsonl.gz").write_bytes(gzip.compress("\n".join(map(json.dumps, lines)).encode()))
    good, bad = readers.edit_layer(spark, str(tmp_path / "e.jsonl.gz"))
    assert sorted((r.x, r.state) for r in good.collect()) == [(1, "a"), (2, "b")] and sorted(r.cx for r in bad.collect()) == [1, 2]


def test_nested_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "named_struct('xmin', id, 'xmax', id + 1, 'ymin', 0, 'ymax', 1) AS bbox").write.parquet(str(tmp_path / "f"))
    f = readers.footprints(spark, str(tmp_path / "f"), 3.5, 0, 4.5, 1)
    assert sorted(r.id for r in f.collect()) == [3, 4]
    assert "bbox.xmin" in f._jdf.queryExecution().executedPlan().toString()
