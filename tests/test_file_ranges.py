"""Point files and region headers by ranges."""

import os
import random
import struct

import numpy as np

from gridloom.sources import file_ranges
from gridloom.sources.readers import POINT


def _points(spark, path, **options):
    file_ranges.register(spark)
    read = spark.read.format("gridloom_points").option("path", path)
    for k, v in options.items():
        read = read.option(k, v)
    return read


def test_many_ranges_equal_one_and_only_touched_ones_are_read(spark, tmp_path):
    r = random.Random(2)
    rows = [(r.randrange(-50_000, 50_000), r.randrange(900), r.randrange(-50_000, 50_000), r.randrange(12), r.random() < 0.1, r.randrange(60_000), r.randrange(8)) for _ in range(20_000)]
    table = spark.createDataFrame(rows, "x long, y long, z long, cls int, withheld boolean, intensity int, strip int")
    path, index = str(tmp_path / "points"), str(tmp_path / "index")
    file_ranges.write_points(table, path, files=3)
    assert not [f for f in os.listdir(path) if f.startswith(".") and not f.endswith(".crc")]
    columns = ["x", "y", "z", "cls", "withheld", "intensity", "strip"]
    whole = _points(spark, path).load()
    assert whole.rdd.getNumPartitions() == len(os.listdir(path))
    split = _points(spark, path, records=777).load()
    assert split.rdd.getNumPartitions() > 20
    assert sorted(map(tuple, split.select(*columns).collect())) == sorted(map(tuple, whole.select(*columns).collect())) == sorted(rows)
    file_ranges.point_index(spark, path, index, records=777)
    box = "x > 10000 AND x <= 14000 AND z >= -3000 AND z < 2000"
    small = _points(spark, path, index=index).schema("x long, z long, cls int").load().where(box)
    assert small.rdd.getNumPartitions() < split.rdd.getNumPartitions() / 3
    assert sorted(map(tuple, small.collect())) == sorted((p[0], p[2], p[3]) for p in rows if 10000 < p[0] <= 14000 and -3000 <= p[2] < 2000)
    assert _points(spark, path, index=index).load().where("x > 90000000").count() == 0
    assert _points(spark, path, index=index).load().count() == len(rows)


def test_return_bits_and_times(spark, tmp_path):
    a = np.zeros(3, POINT)
    a["x"], a["flags"], a["returns"], a["time"] = [1, -2, 3], [0, 4, 0], [0x21, 0x11, 0x22], [0.5, 1.5, 2.5]
    (tmp_path / "p.pts").write_bytes(a.tobytes() + b"rest of a record")
    p = _points(spark, str(tmp_path), records=2).load().orderBy("x").collect()
    assert [(r.x, r.withheld, r.return_number, r.returns, r.time, r.start) for r in p] == [(-2, True, 1, 1, 1.5, 0), (1, False, 1, 2, 0.5, 0), (3, False, 2, 2, 2.5, 2)]


def test_region_headers(spark, tmp_path):
    file_ranges.register(spark)
    header = bytearray(8192)
    for slot, entry in {0: 2 << 8 | 1, 1: 2 << 8 | 1, 2: 900 << 8 | 1, 3: 1 << 8 | 1, 4: 3 << 8 | 1}.items():
        struct.pack_into(">I", header, 4 * slot, entry)
        struct.pack_into(">I", header, 4096 + 4 * slot, 70 + slot)
    body = (struct.pack(">IB", 10, 2) + b"x" * 9).ljust(4096, b"\0") + struct.pack(">IB", 5000, 1).ljust(4096, b"\0")
    (tmp_path / "r.0.0.mca").write_bytes(bytes(header) + body)
    (tmp_path / "r.0.1.mca").write_bytes(b"")
    (tmp_path / "r.0.2.mca").write_bytes(b"short")
    rows = spark.read.format("gridloom_region_headers").option("path", str(tmp_path)).load().collect()
    assert {(r.file[-9:-4], r.slot): (r.error, r.stamp) for r in rows} == {("r.0.0", 0): (None, 70), ("r.0.0", 1): ("overlapping_sectors", 71), ("r.0.0", 2): ("outside_file", 72), ("r.0.0", 3): ("outside_file", 73), ("r.0.0", 4): ("bad_length", 74), ("r.0.2", None): ("bad_file_length", None)}


def test_written_files(spark, tmp_path):
    rows = spark.createDataFrame([("a.bin", bytearray(b"abc")), ("b.bin", bytearray(b""))], "name string, content binary")
    assert {r.bytes for r in file_ranges.write_files(rows, str(tmp_path / "f")).collect()} == {0, 3}
    assert (tmp_path / "f" / "a.bin").read_bytes() == b"abc"
