"""Readers of the inputs: map features, footprints, point records, rasters, edit layers, event logs, manifests.

Each is a plain DataFrame over Spark's own sources; binary records are decoded by numpy inside tasks, a file or a range of a
file at a time. Rows that break a rule go to an `error` column or a reject table, never silently away.
"""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WAYS = "id long, tags map<string,string>, coordinates array<array<double>>, closed boolean"
AREA_KEYS = ["building", "landuse", "natural", "leisure", "amenity", "water"]


def ways(spark: SparkSession, path: str) -> DataFrame:
    """Frozen ways as JSON lines; seq keeps a stable order (by id), never the order of files."""
    return spark.read.schema(WAYS).json(path).withColumn("seq", F.col("id"))


def typed_features(spark: SparkSession, path: str) -> DataFrame:
    """Elements of an extract: tagged nodes are points, closed ways with an area tag polygons, other ways lines."""
    schema = "elements array<struct<type:string,id:long,lat:double,lon:double,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>"
    e = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.*")
    n = F.size("geometry")
    closed = (n >= 4) & (F.col("geometry")[0] == F.element_at("geometry", -1))
    area = F.arrays_overlap(F.map_keys("tags"), F.array(*map(F.lit, AREA_KEYS)))
    kind = F.when((F.col("type") == "node") & (F.size("tags") > 0), "Point").when((F.col("type") == "way") & closed & F.coalesce(area, F.lit(False)), "Polygon").when((F.col("type") == "way") & (n >= 2), "LineString")
    coords = F.when(F.col("type") == "node", F.array(F.struct("lat", "lon"))).otherwise(F.col("geometry"))
    return e.select("id", kind.alias("kind"), "tags", coords.alias("coords")).where("kind IS NOT NULL")


def feature_collection(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(features, faults): GeoJSON polygons by id; ids that are missing or not unique are faults."""
    schema = "features array<struct<id:string,properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.id", "f.properties", "f.geometry.type", F.col("f.geometry.coordinates").alias("rings"))
    faults = f.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL OR id = ''")
    return f, faults


def ring_buildings(spark: SparkSession, path: str) -> DataFrame:
    """Provider footprints in feet: all rings in one array (the even-odd rule makes them an exclusive or), metres by 1200/3937."""
    schema = "features array<struct<attributes:struct<OBJECTID:long,ground:double,height:double>,geometry:struct<rings:array<array<array<double>>>>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    metres = lambda c: F.col(c) * 1200 / 3937
    rings = F.transform("f.geometry.rings", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("z"))))
    return f.select(F.col("f.attributes.OBJECTID").alias("id"), metres("f.attributes.ground").alias("ground_m"), metres("f.attributes.height").alias("height_m"), rings.alias("rings"))


def footprints(spark: SparkSession, path: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """Footprints whose bbox struct meets the query box; the nested filter reaches the Parquet scan."""
    return spark.read.parquet(path).where(f"bbox.xmin <= {east} AND bbox.xmax >= {west} AND bbox.ymin <= {north} AND bbox.ymax >= {south}")


#: The uncompressed 30-byte point record: centimetre integers, intensity, return bits, class, then strip and time.
POINT = np.dtype([("x", "<i4"), ("y", "<i4"), ("z", "<i4"), ("intensity", "<u2"), ("returns", "u1"), ("flags", "u1"), ("cls", "u1"), ("user", "u1"), ("angle", "<i2"), ("strip", "<u2"), ("time", "<f4"), ("pad", "V2")])


def point_records(spark: SparkSession, path: str) -> DataFrame:
    """Point files of fixed-size records -> x, y, z, cls, withheld, intensity, return_number, returns, strip, time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                a = np.frombuffer(raw.as_py(), POINT, count=len(raw.as_py()) // POINT.itemsize)
                for i in range(0, len(a), 50_000):
                    p = a[i : i + 50_000]
                    columns = [p["x"].astype(np.int64), p["y"].astype(np.int64), p["z"].astype(np.int64), p["cls"].astype(np.int32), (p["flags"] & 4) != 0, p["intensity"].astype(np.int32), (p["returns"] & 15).astype(np.int32), (p["returns"] >> 4).astype(np.int32), p["strip"].astype(np.int32), p["time"].astype(np.float64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "z", "cls", "withheld", "intensity", "return_number", "returns", "strip", "time"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "x long, y long, z long, cls int, withheld boolean, intensity int, return_number int, returns int, strip int, time double")


def octree_nodes(spark: SparkSession, path: str, bounds: tuple[float, float, float, float], query: tuple[float, float, float, float]) -> DataFrame:
    """Nodes of a hierarchy listing ({"d-x-y-z": count}) whose square meets the query box; count -1 (another page) is kept apart by `page`."""
    x0, y0, x1, y1 = bounds
    listed = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,long>")).alias("key", "count"))
    part = F.split("key", "-")
    n = listed.select("key", "count", *[part[i].cast("long").alias(c) for i, c in enumerate(("depth", "nx", "ny", "nz"))])
    side = (x1 - x0) / F.pow(F.lit(2.0), "depth")
    n = n.withColumns({"west": F.lit(x0) + F.col("nx") * side, "south": F.lit(y0) + F.col("ny") * side, "side": side, "page": F.col("count") == -1})
    return n.where((F.col("west") <= query[2]) & (F.col("west") + F.col("side") >= query[0]) & (F.col("south") <= query[3]) & (F.col("south") + F.col("side") >= query[1]))


def raster_cells(tiles: DataFrame) -> DataFrame:
    """tiles (layer, x0, z0, width, values) -> layer, x, z, value: a row per known cell."""
    return tiles.select("layer", "x0", "z0", "width", F.posexplode("values").alias("i", "value")).where("value IS NOT NULL").select("layer", (F.col("x0") + F.col("i") % F.col("width")).alias("x"), (F.col("z0") + F.floor(F.col("i") / F.col("width"))).alias("z"), "value")


def bathymetry(spark: SparkSession, path: str) -> DataFrame:
    """Gzip files of a JSON header line and little-endian int16 depths -> row, col, lon, lat, value; no data is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                head, _, body = gzip.decompress(raw.as_py()).partition(b"\n")
                h = json.loads(head)
                v = np.frombuffer(body, "<i2")
                row, col = np.divmod(np.arange(len(v)), h["width"])
                known = v != h.get("nodata", -32768)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(col), pa.array(h["west"] + col * h["step"]), pa.array(h["north"] - row * h["step"]), pa.array(np.where(known, v * h["scale"], 0.0), mask=~known)], names=["row", "col", "lon", "lat", "value"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "row long, col long, lon double, lat double, value double")


def region_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Region files -> path, slot, cx, cz, offset, sectors, length, compression, error: one row per chunk in the 8 KB header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "slot", "cx", "cz", "offset", "sectors", "length", "compression", "error"]
        kinds = [pa.string(), *[pa.int32()] * 7, pa.string()]
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, taken = [], {}
                if len(raw) < 8192:
                    rows.append((name, None, None, None, None, None, None, None, "short_header"))
                for slot in range(1024) if len(raw) >= 8192 else ():
                    entry = struct.unpack(">I", raw[4 * slot : 4 * slot + 4])[0]
                    offset, sectors = entry >> 8, entry & 255
                    if not entry:
                        continue
                    error = length = kind = None
                    if offset < 2 or (offset + sectors) * 4096 > len(raw) + 4095:
                        error = "outside_file"
                    elif any(s in taken for s in range(offset, offset + sectors)):
                        error = "overlapping_sectors"
                    else:
                        length, kind = struct.unpack(">IB", raw[offset * 4096 : offset * 4096 + 5])
                        error = "bad_length" if length < 1 or length + 4 > sectors * 4096 else None
                    taken.update(dict.fromkeys(range(offset, offset + sectors), slot))
                    rows.append((name, slot, slot % 32, slot // 32, offset, sectors, length, kind, error))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 9, kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, slot int, cx int, cz int, offset int, sectors int, length int, compression int, error string")


def edit_layer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Gzip JSON lines, a header with the palette and a line of parallel arrays per chunk -> (edits, rejected chunks)."""
    schema = "schema string, palette array<string>, cx long, cz long, x array<long>, y array<long>, z array<long>, p array<int>, s array<int>"
    lines = spark.read.schema(schema).json(path).withColumn("file", F.input_file_name())
    palette = lines.where("schema IS NOT NULL").select("file", "palette")
    rows = lines.where("schema IS NULL").drop("palette", "schema").join(palette, "file")
    sound = (F.size("x") == F.size("y")) & (F.size("x") == F.size("z")) & (F.size("x") == F.size("p")) & (F.size("x") == F.size("s")) & F.forall("p", lambda i: (i >= 0) & (i < F.size("palette")))
    e = rows.where(sound).select("palette", F.explode(F.arrays_zip("x", "y", "z", "p", "s")).alias("e"))
    edits = e.select("e.x", "e.y", "e.z", F.element_at("palette", F.col("e.p") + 1).alias("state"), F.col("e.s").alias("source_id"))
    return edits, rows.where(~sound).select("file", "cx", "cz")


def write_edit_layer(edits: DataFrame, path: str) -> DataFrame:
    """One gzip JSON file set per region, chunks with their edits sorted by cell; returns the manifest: region, chunks, edits, sha256."""
    keyed = edits.withColumns({"cx": F.shiftright("x", 4), "cz": F.shiftright("z", 4)}).withColumns({"rx": F.shiftright("cx", 5), "rz": F.shiftright("cz", 5)})
    chunks = keyed.groupBy("rx", "rz", "cx", "cz").agg(F.array_sort(F.collect_list(F.struct("x", "z", "y", "state"))).alias("edits"))
    chunks.repartition("rx", "rz").sortWithinPartitions("rx", "rz", "cz", "cx").write.partitionBy("rx", "rz").option("compression", "gzip").json(path)
    body = F.sha2(F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct("cx", "cz", "edits")))), "\n"), 256)
    return chunks.groupBy("rx", "rz").agg(F.count("*").alias("chunks"), F.sum(F.size("edits")).alias("edits"), body.alias("sha256"))


def event_log(spark: SparkSession, path: str, since: str) -> DataFrame:
    """JSON event lines among other text, newer than a time."""
    e = spark.read.text(path).select(F.from_json("value", "utc timestamp, event string, tile string, seconds double, phases map<string,double>").alias("e")).select("e.*")
    return e.where(F.col("utc") >= F.lit(since).cast("timestamp"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Every file under a root: path, bytes, sha256."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_shards(files: DataFrame, span: int, path: str) -> None:
    """A snapshot in shards of span x span regions; files that belong to no region go to the shard `metadata`."""
    rx, rz = (F.regexp_extract("path", r"r\.(-?\d+)\.(-?\d+)\.", k) for k in (1, 2))
    shard = F.when(rx != "", F.concat(F.lit("x"), F.floor(rx.try_cast("long") / span), F.lit("_z"), F.floor(rz.try_cast("long") / span))).otherwise("metadata")
    files.withColumn("shard", shard).write.partitionBy("shard").parquet(path)


def region_index(chunks: DataFrame) -> DataFrame:
    """region_chunks rows -> one record per region file: chunks, bitmap (bits of the slots in 32 words), ordered by path."""
    word = chunks.where("error IS NULL").groupBy("path", F.floor(F.col("slot") / 32).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot") % 32)).alias("bits"), F.count("*").alias("n"))
    return word.groupBy("path").agg(F.sum("n").alias("chunks"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("w", "bits")))).alias("bitmap")).orderBy("path")


def roof_faces(spark: SparkSession, path: str) -> DataFrame:
    """City-model lines -> feature, face, ring: faces whose semantic is RoofSurface, with vertices scaled and moved."""
    schema = "id string, transform struct<scale:array<double>,translate:array<double>>, vertices array<array<long>>, faces array<struct<semantic:string,ring:array<int>>>"
    f = spark.read.schema(schema).json(path)
    at = lambda i: F.transform(F.array(*map(F.lit, range(3))), lambda k: F.get(F.get("vertices", i), k) * F.get(F.col("transform.scale"), k) + F.get(F.col("transform.translate"), k))
    return f.select("id", "transform", "vertices", F.posexplode("faces").alias("face", "f")).where("f.semantic = 'RoofSurface'").select("id", "face", F.transform("f.ring", at).alias("ring"))


def inflate(raw: bytes, compression: int) -> bytes:
    """The payload of a region chunk: 1 gzip, 2 zlib, 3 plain."""
    return {1: gzip.decompress, 2: zlib.decompress, 3: bytes}[compression](raw)


def csv_table(spark: SparkSession, path: str, schema: str, columns: list[str], where: str = "true") -> DataFrame:
    """A keyed CSV table with a header: stated types, only the wanted columns and rows. A value that its type can't hold is null."""
    return spark.read.csv(path, schema=schema, header=True).where(where).select(*columns)


#: Placemarks of one file: some 20 MB.
PLACEMARKS = 50_000


def write_placemarks(buildings: DataFrame, path: str) -> None:
    """buildings (id, name, height, ring of (lon, lat)) -> XML, a Placemark each; rows without a positive height or a closed ring of four points are left out. A file has at most PLACEMARKS of them, since XML is read whole, file by file."""
    ring = F.col("ring")
    closed = (F.size("ring") >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    at = F.array_join(F.transform(ring, lambda p: F.concat_ws(",", p["lon"].cast("string"), p["lat"].cast("string"), F.lit("0"))), " ")
    data = lambda name, value: F.struct(F.lit(name).alias("_name"), value.cast("string").alias("value"))
    place = F.struct(F.struct(F.struct(at.alias("coordinates")).alias("LinearRing")).alias("outerBoundaryIs"))
    rows = buildings.where((F.col("height") > 0) & closed)
    rows = rows.select(F.coalesce("name", F.concat(F.lit("way "), F.col("id").cast("string"))).alias("name"), F.struct(F.array(data("height_m", F.col("height")), data("source", F.concat(F.lit("way "), F.col("id").cast("string")))).alias("Data")).alias("ExtendedData"), place["outerBoundaryIs"].alias("outerBoundaryIs"))
    rows.select("name", "ExtendedData", F.struct("outerBoundaryIs").alias("Polygon")).write.format("xml").option("rootTag", "Document").option("rowTag", "Placemark").option("maxRecordsPerFile", PLACEMARKS).save(path)


def placemarks(spark: SparkSession, path: str) -> DataFrame:
    """name, data (map), coordinates of each Placemark."""
    schema = "name string, ExtendedData struct<Data: array<struct<_name: string, value: string>>>, Polygon struct<outerBoundaryIs: struct<LinearRing: struct<coordinates: string>>>"
    read = spark.read.format("xml").option("rowTag", "Placemark").schema(schema).load(path)
    return read.select("name", F.map_from_entries("ExtendedData.Data").alias("data"), F.col("Polygon.outerBoundaryIs.LinearRing.coordinates").alias("coordinates"))
