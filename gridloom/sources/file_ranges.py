"""Binary files read by ranges: point records with box pushdown over a range index, and region headers of 8 KB.

Both are Python data sources whose partitions are parts of files, opened through the file system that the path names. Files
come from Spark tasks that write under a temporary name and then rename, so a task that runs again leaves one file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from gridloom.sources.readers import POINT

#: Records of one partition: some 30 MB.
RECORDS = 1_000_000
POINT_SCHEMA = "file string, start long, x long, y long, z long, cls int, withheld boolean, intensity int, return_number int, returns int, strip int, time double"
_BATCH = 65_536


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str, ending: str) -> list[tuple[str, int]]:
    system, root = _opened(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith(ending))


def write_files(rows: DataFrame, path: str) -> DataFrame:
    """rows (name, content binary) -> one file each below path; result: file, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(path)
        system.create_dir(root)
        for batch in batches:
            names, sizes = [], []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = f"{root}/.{uuid.uuid4().hex}"
                with system.open_output_stream(own) as out:
                    out.write(content.as_buffer())
                system.move(own, f"{root}/{name}")
                names.append(f"{root}/{name}")
                sizes.append(len(content.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["file", "bytes"])

    return rows.select("name", "content").mapInArrow(run, "file string, bytes long")


def write_points(points: DataFrame, path: str, files: int) -> None:
    """points (x, y, z, cls, withheld, intensity, strip) -> record files whose neighbours in the file are neighbours on the ground."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(path)
        system.create_dir(root)
        own, name, n = f"{root}/.{uuid.uuid4().hex}", None, 0
        with system.open_output_stream(own) as out:
            for batch in batches:
                if not len(batch):
                    continue
                record = np.zeros(len(batch), POINT)
                column = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names)}
                for c in ("x", "y", "z", "cls", "intensity", "strip"):
                    record[c] = column[c]
                record["flags"], record["returns"] = column["withheld"].astype(np.uint8) << 2, 0x11
                name = name or f"points-{int(column['part'][0]):05}.pts"
                out.write(record.tobytes())
                n += len(record)
        system.move(own, f"{root}/{name}") if name else system.delete_file(own)
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([n], pa.int64())], ["name", "n"])

    placed = points.repartitionByRange(files, F.floor(F.col("x") / 6400), F.floor(F.col("z") / 6400)).sortWithinPartitions(F.floor(F.col("x") / 6400), F.floor(F.col("z") / 6400), "x", "z", "y")
    placed.withColumn("part", F.spark_partition_id()).mapInArrow(run, "name string, n long").write.format("noop").mode("overwrite").save()


@dataclass
class Records(InputPartition):
    file: str
    start: int
    count: int


class _PointReader(DataSourceReader):
    def __init__(self, options: dict, wanted: list[str]):
        self.path, self.index, self.wanted = options["path"], options.get("index"), wanted
        self.records = int(options.get("records", RECORDS))
        self.low, self.high = {}, {}

    def pushFilters(self, filters):
        """Bounds of x and z choose ranges, and rows within them; all filters stay with Spark too."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in ("x", "z"):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low[name] = max(self.low.get(name, f.value), f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high[name] = min(self.high.get(name, f.value), f.value)
            yield f

    def partitions(self) -> list[Records]:
        if self.index:
            system, root = _opened(self.index)
            parts, met = ds.dataset(root, filesystem=system, format="parquet"), ds.scalar(True)
            for name, v in self.low.items():
                met = met & (ds.field(f"{name}_high") >= v)
            for name, v in self.high.items():
                met = met & (ds.field(f"{name}_low") <= v)
            return [Records(**r) for r in parts.to_table(["file", "start", "count"], filter=met).to_pylist()]
        step, size = self.records, POINT.itemsize
        return [Records(file, start, min(step, n // size - start)) for file, n in _files(self.path, ".pts") for start in range(0, n // size, step)]

    def read(self, part: Records | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no range at all
            return
        with _opened(self.path)[0].open_input_file(part.file) as f:
            for begin in range(part.start, part.start + part.count, _BATCH):
                f.seek(begin * POINT.itemsize)
                raw = f.read(min(_BATCH, part.start + part.count - begin) * POINT.itemsize)
                p = np.frombuffer(raw, POINT, len(raw) // POINT.itemsize)
                keep = np.ones(len(p), bool)
                for name, v in self.low.items():
                    keep &= p[name] >= v
                for name, v in self.high.items():
                    keep &= p[name] <= v
                p = p[keep]
                yield pa.RecordBatch.from_arrays([self._column(c, p, part) for c in self.wanted], self.wanted)

    @staticmethod
    def _column(name: str, p: np.ndarray, part: Records) -> pa.Array:
        if name == "file":
            return pa.array([part.file] * len(p), pa.string())
        if name == "start":
            return pa.array(np.full(len(p), part.start, np.int64))
        if name == "withheld":
            return pa.array((p["flags"] & 4) != 0)
        if name in ("return_number", "returns"):
            return pa.array((p["returns"] & 15 if name == "return_number" else p["returns"] >> 4).astype(np.int32))
        kind = np.int64 if name in ("x", "y", "z") else np.float64 if name == "time" else np.int32
        return pa.array(p[name].astype(kind))


class PointFiles(DataSource):
    """Options: path; records, of a range; index, a table of `point_index`. A schema with fewer columns reads only those."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_points"

    def schema(self) -> str:
        return POINT_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PointReader(dict(self.options), schema.fieldNames())


def point_index(spark: SparkSession, path: str, out: str, records: int = RECORDS) -> None:
    """The bounding box of every record range of the point files below path."""
    register(spark)
    points = spark.read.format("gridloom_points").schema("file string, start long, x long, z long").option("path", path).option("records", records).load()
    points.groupBy("file", "start").agg(F.count("*").alias("count"), *(f(c).alias(f"{c}_{n}") for c in "xz" for f, n in ((F.min, "low"), (F.max, "high")))).write.parquet(out)


class _HeaderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        found = _files(self.path, ".mca")
        return [InputPartition(found[i : i + 64]) for i in range(0, len(found), 64)]

    def read(self, part: InputPartition | None) -> Iterator[tuple]:
        if part is None:
            return
        system = _opened(self.path)[0]
        for file, size in part.value:
            if size == 0:
                continue
            if size < 8192 or size % 4096:
                yield file, None, None, None, None, None, None, "bad_file_length"
                continue
            with system.open_input_file(file) as f:
                header = f.read(8192)
                entries, stamps = np.frombuffer(header, ">u4", 1024), np.frombuffer(header, ">u4", 1024, 4096)
                used: set[int] = set()
                for slot in np.flatnonzero(entries).tolist():
                    first, count = int(entries[slot]) >> 8, int(entries[slot]) & 255
                    span, length, kind, error = range(first, first + count), None, None, None
                    if first < 2 or not count or (first + count) * 4096 > size:
                        error = "outside_file"
                    elif used.intersection(span):
                        error = "overlapping_sectors"
                    else:
                        f.seek(first * 4096)
                        length, kind = struct.unpack(">IB", f.read(5))
                        error = None if 1 < length <= count * 4096 - 4 else "bad_length"
                    used.update(span)
                    yield file, slot, first, count, length, kind, int(stamps[slot]), error


class RegionHeaders(DataSource):
    """A row per used slot of the region files below `path`; of a file only the header and five bytes a chunk are read."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_region_headers"

    def schema(self) -> str:
        return "file string, slot int, sector int, sectors int, length int, compression int, stamp int, error string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _HeaderReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PointFiles)
    spark.dataSource.register(RegionHeaders)
