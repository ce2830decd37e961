"""WARC archives: a writer with payload-digest revisits, and a splittable reader.

Writer: one gzip member per record (WARC/1.1, an HTTP response block), so archives can be cut anywhere between members.
Equal payloads are found by SHA-1; of those with at least `min_revisit_bytes` bytes the row with the largest id is the
response, the others are revisits, which hold the HTTP header only and refer to it.

Reader: tasks get byte ranges of the archives, scan them for the gzip magic, decode the record header of each candidate and
follow the members from it to the place where the chain leaves the range. A magic inside another member (of an archive
within a payload, say) starts a chain too, so the chain from a file's first byte decides which starts are true: one small
row per chain, put together per file. Each range then owns and streams the records that start inside it, one payload at a
time in memory, however long. Where the chain breaks off the archive is damaged; that is an error, whatever the ranges.

Results for odd inputs: null payloads are empty; a null id is the smallest, so such a row is the response only if it has
no equal with an id, and refers_to is then null for all; rows that repeat the largest id are all responses; an empty table
gives no archives and no records; columns other than page_id, url and html are left out, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, scratch, tune

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page:"


def _record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    uri = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{ID}{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{ID}{refers}>"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, min_revisit_bytes: int = 0, level: int = 3) -> DataFrame:
    """pages (page_id, url, html) -> the archives written: path, bytes, records.

    The digest is computed and grouped in the JVM. Payloads are shuffled once, by digest, to meet their group's largest
    id; a group of copies with a large share of all rows is a skewed join, which adaptive execution splits.
    """
    spark = pages.sparkSession
    tune(spark)
    root = scratch(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload")).withColumn("sha1", F.sha1("payload"))
    groups = materialize(rows.where(F.length("payload") >= min_revisit_bytes).groupBy("sha1").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    decided = rows.join(groups, "sha1", "left").select("page_id", "url", "payload", "sha1", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(root)
        files.create_dir(base, recursive=True)
        path, out, size, n = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for page, url, payload, sha1, refers in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if out is None:
                    out = files.open_output_stream(path, compression=None)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = gz.compress(_record("response" if refers is None else "revisit", page, url, payload, digest, refers)) + gz.flush()
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

    written = materialize(decided.mapInArrow(write, "path string, bytes long, records long"), "warc-list")
    return written.withColumn("root", F.lit(root))


def _headers(text: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in text.decode("utf-8", "replace").split("\r\n")[1:])}


class _Window:
    """Buffered reads at any place of a file, in large blocks."""

    def __init__(self, file: pa.NativeFile, size: int, block: int = 1 << 20):
        self.file, self.size, self.block, self.start, self.data = file, size, block, 0, memoryview(b"")

    def at(self, place: int, least: int) -> memoryview:
        if not (self.start <= place and place + min(least, self.size - place) <= self.start + len(self.data)):
            self.file.seek(place)
            self.start, self.data = place, memoryview(self.file.read(max(self.block, least)))
        return self.data[place - self.start :]


def _member(win: _Window, place: int, keep: bool) -> tuple[bytes | None, int] | None:
    """(content, next place) of the member at `place`; None if there is no sound WARC member. keep=False: the header alone."""
    gz, parts, at, step = zlib.decompressobj(31), [], place, 1 << 12
    first = b""  # a window may end within a member's first bytes, so these can come in pieces
    try:
        while not gz.eof:
            if at >= win.size:
                return None
            data, step = win.at(at, 1)[:step], min(step * 4, 1 << 18)
            raw = gz.decompress(data)
            at += len(data)
            if len(first) < len(VERSION):
                first += raw[: len(VERSION)]
                if not first.startswith(VERSION[: len(first)]):
                    return None
            if keep:
                parts.append(raw)
    except zlib.error:
        return None
    return (b"".join(parts), at - len(gz.unused_data)) if first.startswith(VERSION) else None


def _chains(win: _Window, start: int, end: int) -> list[tuple[int, int | None]]:
    """(first place, place where it leaves the range or None where it breaks off) of the chains of members that start in [start, end).

    Places on a chain that was followed before are not followed again, so the work is linear in the range.
    """
    found, leaves, place = [], {}, start
    while place < end:
        data = bytes(win.at(place, 1 << 16)[: min(1 << 18, end - place + 2)])
        i = data.find(MAGIC)
        if i < 0:
            place += max(1, len(data) - 2)
            continue
        place += i
        if place >= end:
            break
        if place not in leaves:
            at, walked = place, []
            while at < end and at not in leaves:
                got = _member(win, at, False)
                if got is None:
                    break
                walked.append(at)
                at = got[1]
            out = leaves.get(at) if at in leaves else at if at >= end or at >= win.size else None
            leaves.update(dict.fromkeys(walked, out))
            if walked:
                found.append((place, out))
        place += 1
    return found


def _true_starts(chains: DataFrame, split_bytes: int) -> DataFrame:
    """chains (root, path, bytes, start, first, leaves) -> root, path, bytes, start, first of the ranges that own records: the chain from a file's first byte."""

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        root, path, size = rows["root"].iloc[0], rows["path"].iloc[0], int(rows["bytes"].iloc[0])
        known = {int(a): None if pd.isna(b) else int(b) for a, b in zip(rows["first"], rows["leaves"]) if not pd.isna(a)}
        place, out = 0, []
        while place < size:
            out.append((root, path, size, place // split_bytes * split_bytes, place))
            place = known.get(place)
            if place is None:
                raise ValueError(f"broken record at {path}:{out[-1][4]} or behind it")
        return pd.DataFrame(out, columns=["root", "path", "bytes", "start", "first"])

    return chains.groupBy("path").applyInPandas(follow, "root string, path string, bytes long, start long, first long")


def _split_bytes(archives: DataFrame) -> int:
    """Ranges that give each partition about four of them, within 64 KiB and 64 MiB: archives of any size are read by many tasks."""
    total = archives.agg(F.sum("bytes")).first()[0] or 0
    return min(max(total // (4 * partitions(archives.sparkSession)), 1 << 16), 64 << 20)


def read_warc(archives: DataFrame, split_bytes: int | None = None) -> DataFrame:
    """archives (path, bytes, root) -> path, place, record_type, record_id, target_uri, payload_digest, payload_bytes, refers_to, payload.

    payload is null for revisits; payload_bytes is then what the HTTP header says. A response whose payload does not have
    its digest is an error, and so is a damaged member, at every size of range. split_bytes: the ranges' size, None for one from the archives' bytes; results don't depend on it.
    """
    spark = archives.sparkSession
    split_bytes = split_bytes or _split_bytes(archives)
    tune(spark)
    ranges = archives.select("root", "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    dealt = ranges.repartition(partitions(spark), "path", "start")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, path, size, start in zip(*(batch.column(k).to_pylist() for k in range(4))):
                files, _ = pafs.FileSystem.from_uri(root)
                with files.open_input_file(path) as file:
                    chains = _chains(_Window(file, size), start, min(size, start + split_bytes)) or [(None, None)]
                columns = [[root] * len(chains), [path] * len(chains), [size] * len(chains), [start] * len(chains), *zip(*chains)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.string(), *[pa.int64()] * 4])], names=["root", "path", "bytes", "start", "first", "leaves"])

    chains = dealt.mapInArrow(scan, "root string, path string, bytes long, start long, first long, leaves long")
    owned = materialize(_true_starts(chains, split_bytes), "warc-ranges").repartition(partitions(spark), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, path, size, start, place in zip(*(batch.column(k).to_pylist() for k in range(5))):
                files, _ = pafs.FileSystem.from_uri(root)
                with files.open_input_file(path) as file:
                    win, end = _Window(file, size), min(size, start + split_bytes)
                    rows, held = [], 0
                    while place < end:
                        got = _member(win, place, True)
                        if got is None:
                            raise ValueError(f"broken record at {path}:{place}")
                        head, _, block = got[0].partition(b"\r\n\r\n")
                        warc = _headers(head)
                        http, _, body = block[: int(warc["content-length"])].partition(b"\r\n\r\n")
                        http_length = int(_headers(http).get("content-length", len(body)))
                        digest = warc.get("warc-payload-digest", "").removeprefix("sha1:")
                        response = warc["warc-type"] != "revisit"
                        if response:
                            if digest and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                                raise ValueError(f"payload digest differs at {path}:{place}")
                            http_length = len(body)
                        rows.append((path, place, warc["warc-type"], warc["warc-record-id"].strip("<>"), warc.get("warc-target-uri"), digest, http_length, warc.get("warc-refers-to", "").strip("<>") or None, body if response else None))
                        held += len(body)
                        place = got[1]
                        if held > 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    return owned.mapInArrow(read, "path string, place long, record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["path", "place", "record_type", "record_id", "target_uri", "payload_digest", "payload_bytes", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def page_of(column: str) -> Column:
    """The page id in a record id; null where it has none."""
    return F.expr(f"try_cast(nullif(substring({column}, {len(ID) + 1}), '') AS BIGINT)")
