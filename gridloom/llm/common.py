"""Shared helpers of the training-data operators: scratch folders, text bytes and rolling hashes."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are cut at this many rows and bytes, so that a Python worker holds a few tens of MB of text.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

_own_scratch: list[str] = []


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir); a temporary one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not _own_scratch:
            _own_scratch.append("file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
        root = _own_scratch[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to shared scratch and read back: cuts the lineage with a copy that outlives any executor."""
    path = scratch(df.sparkSession, name)
    if (held := _passing.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def distilled(spark: SparkSession, result: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result written as `name`, after which all that was materialized to make it is deleted from shared scratch."""
    held: list[str] = []
    token = _passing.set(held)
    try:
        made = result()
        _passing.reset(token)
        token = None
        kept = materialize(made, name)
    finally:
        if token is not None:
            _passing.reset(token)
        for path in held:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return kept


def release(spark: SparkSession) -> None:
    """Drop shuffle files of finished jobs that nothing refers to any more (Spark's cleaner follows the driver's garbage)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_libc: list[ctypes.CDLL] = []


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of batches; at the task's end its freed memory goes back to the system, as workers live on idle beside later stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if not _libc:
            _libc.append(ctypes.CDLL(ctypes.util.find_library("c") or None))
        if hasattr(_libc[0], "malloc_trim"):
            _libc[0].malloc_trim(0)

    return tidied


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def aside(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """docs with every column but the needed ones under a name of its own (no operator uses such names), and the name that each column now has."""
    names = {c: c if c in needed else f"_own{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(names: dict[str, str], without: list[str] | None = None) -> list[Column]:
    """The columns of a table put aside, under their own names again."""
    return [F.col(now).alias(c) for c, now in names.items() if c not in (without or [])]


def doc_key(column: str = "doc_id") -> Column:
    """The id as a sort key; null counts as the smallest."""
    return F.coalesce(F.col(column).cast("long"), F.lit(-(2**63)))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """The UTF-8 bytes of each text as views into the Arrow buffer; null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    if len(array) == 0:
        return []
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if array.null_count:
        known = array.is_valid().to_numpy(zero_copy_only=False)
        return [whole[a:b] if ok else whole[:0] for a, b, ok in zip(ends[:-1], ends[1:], known)]
    return [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]


# --- rolling hashes: prefix sums of byte codes times powers of an odd number, modulo 2^64 ---

_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        base = _BASE if which == "up" else pow(_BASE, -1, 2**64)
        p = np.full(max(n, 1 << 16, 2 * len(_powers[which])), base, np.uint64)
        p[0] = 1
        _powers[which] = np.multiply.accumulate(p)
    return _powers[which][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class RollingHash:
    """Hashes of any byte range of one text in constant time each."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * _power("up", n), out=self.sums[1:])
        self.down = _power("down", n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def windows(self, size: int) -> np.ndarray:
        m = len(self.sums) - size
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:m]) * self.down[:m] + np.uint64(size * 0xA24BAED4963EE407 % 2**64))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each full window, by doubling."""
    step, m = 1, values
    while step * 2 <= width:
        m = pick(m[:-step], m[step:])
        step *= 2
    if step < width:
        m = pick(m[: len(m) - (width - step)], m[width - step :])
    return m


def frequent_keys(per_task: DataFrame, limit: int, least: int) -> np.ndarray:
    """The keys that occur most, at most `limit` of them, sorted: per_task has (key long, n long), counts of whole partitions from which keys seen once there may be missing.

    The list only orders work (what goes last, what is salted); results don't depend on it.
    """
    rows = per_task.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(limit).select("key").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64))
