"""Content-addressed token store.

Layout of a store: packs of chunks (unsigned little-endian ids of `width` bytes, a Zstandard frame each), each unique chunk stored
once; recipes, a Parquet table in ascending document order with each document's chunk digests and Merkle root; an index
from digest to pack, place and size; a manifest with one Merkle root per recipe file and their count.

A rolling hash over the last 16 ids of a document cuts its id stream, so that equal passages give equal chunks wherever
they stand. Tasks spool their chunks to files of their own (equal chunks of a task once); the smallest (file, place) of
each digest owns it; files that hold chunks owned elsewhere are rewritten without them. Payload bytes never go through a
shuffle: digests, places and recipes do. File names are unique per attempt and only rows that Spark commits name them, so
retried tasks and lost executors leave no double records.

Results for odd inputs: null or empty texts have the end id alone; rows with equal ids are stored each and come in order
of their root; a null id comes first; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_key, materialize, mix, partitions, scratch, tidy, tune
from .tokens import END_ID, encoder

DIGEST = 16
#: A writing task remembers this many of its chunks (some 50 MB).
KNOWN_CHUNKS = 200_000


def chunk_ends(ids: np.ndarray, mean: int = 1024, least: int = 128, most: int = 8192, window: int = 16) -> list[int]:
    """Ends of the content-defined chunks of an id stream."""
    n = len(ids)
    if n <= least:
        return [n]
    h, step, factor = mix(ids.astype(np.uint64) + np.uint64(1)), 1, 0x9E3779B97F4A7C15
    while step < window:  # the hash of 2k ids is that of k ids and that of the k before, times a power
        later = h.copy()
        later[step:] += h[:-step] * np.uint64(factor)
        h, step, factor = later, step * 2, factor * factor % 2**64
    cuts = np.flatnonzero(mix(h) < np.uint64(2**64 // mean)) + 1
    ends, last = [], 0
    for c in cuts.tolist():
        if c - last < least:
            continue
        while c - last > most:
            last += most
            ends.append(last)
        if c - last >= least:
            ends.append(c)
            last = c
    while n - last > most:
        last += most
        ends.append(last)
    return ends if last == n else [*ends, n]


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of a binary Merkle tree; an odd node goes up as it is. No leaves: the digest of nothing."""
    if not leaves:
        return digest(b"")
    while len(leaves) > 1:
        leaves = [digest(b"\x01" + leaves[i] + leaves[i + 1]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0]


def _fold(recipes: DataFrame) -> DataFrame:
    """recipes -> part, ids, docs, root: the counts and the Merkle root over the documents' roots of each part."""
    parts = recipes.groupBy("part").agg(F.sum("n_tokens").alias("ids"), F.count("*").alias("docs"), F.transform(F.array_sort(F.collect_list(F.struct("row", "root"))), lambda x: x["root"]).alias("roots"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, ids, docs, roots = (batch.column(k).to_pylist() for k in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(ids, pa.int64()), pa.array(docs, pa.int64()), pa.array([merkle(r) for r in roots], pa.binary())], names=["part", "ids", "docs", "root"])

    return parts.mapInArrow(tidy(fold), "part int, ids long, docs long, root binary")


def write_store(docs: DataFrame, path: str, kind: str = "word", width: int = 2) -> dict[str, DataFrame | str | int]:
    """Encode documents and store their ids in `width` bytes each (an id that needs more is an error); returns the store's tables: recipes, index, manifest, and its root folder and width."""
    spark = docs.sparkSession
    tune(spark)
    root = scratch(spark, "token-store")
    form = f"<u{width}"

    def spool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, kind)
        files, base = pafs.FileSystem.from_uri(root)
        files.create_dir(f"{base}/packs", recursive=True)
        name, out, at = f"{uuid.uuid4().hex}.pack", None, 0
        known: dict[bytes, tuple[int, int]] = {}  # cleared when full: what is then stored again goes when packs are compacted
        end = np.array([END_ID], "<u4").tobytes()
        frame = zstandard.ZstdCompressor(level=1)
        if enc.tokenizer.get_vocab_size() > 1 << 8 * width:
            raise ValueError(f"ids of this tokenizer do not fit {width} bytes")
        try:
            for batch in batches:
                rows: list[tuple] = []
                for doc, data in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist())):
                    ids = np.frombuffer(data + end, "<u4")
                    start, leaves, sizes, places = 0, [], [], []
                    for e in chunk_ends(ids):
                        raw = ids[start:e].astype(form).tobytes()
                        key = digest(raw)
                        if key not in known:
                            if len(known) >= KNOWN_CHUNKS:
                                known.clear()
                            if out is None:
                                out = files.open_output_stream(f"{base}/packs/{name}")
                            packed = frame.compress(raw)
                            out.write(packed)
                            known[key] = (at, len(packed))
                            at += len(packed)
                        leaves.append(key)
                        sizes.append(e - start)
                        places.append(known[key])
                        start = e
                    rows.append((doc, len(ids), merkle(leaves), b"".join(leaves), sizes, [p[0] for p in places], [p[1] for p in places], name))
                d, n, r, leaf, sizes, places, packed, f = zip(*rows) if rows else ((),) * 8
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d, pa.int64()), pa.array(n, pa.int64()), pa.array(r, pa.binary()), pa.array(leaf, pa.binary()), pa.array(sizes, pa.list_(pa.int32())), pa.array(places, longs), pa.array(packed, longs), pa.array(f, pa.string())],
                    names=["doc_id", "n_tokens", "root", "chunks", "sizes", "places", "packed", "pack"],
                )
        finally:
            if out is not None:
                out.close()

    schema = "doc_id long, n_tokens long, root binary, chunks binary, sizes array<int>, places array<long>, packed array<long>, pack string"
    spooled = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(spool), schema), "spooled")
    each = spooled.select("pack", F.posexplode("places").alias("i", "place"), "chunks", "packed").select(
        F.expr(f"substring(chunks, i * {DIGEST} + 1, {DIGEST})").alias("digest"), "pack", "place", F.col("packed")[F.col("i")].alias("packed")
    )
    # the owner of a digest is its first (pack, place)
    copies = each.groupBy("digest", "pack", "place", "packed").agg(F.count("*").alias("uses"))
    owners = materialize(copies.groupBy("digest").agg(F.min(F.struct("pack", "place", "packed")).alias("at"), F.sum("uses").alias("uses")).select("digest", "at.*", "uses"), "owners")

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one old pack after another, by place: copy what is owned to a new pack, drop the old one."""
        files, base = pafs.FileSystem.from_uri(root)
        source = target = old = new = None
        at = 0
        for batch in batches:
            out = {"digest": [], "pack": [], "place": [], "packed": []}
            for key, pack, place, size in zip(*(batch.column(c).to_pylist() for c in ("digest", "pack", "place", "packed"))):
                if pack != old:
                    if target is not None:
                        target.close()
                        source.close()
                    source, new, at, old = files.open_input_file(f"{base}/packs/{pack}"), f"{uuid.uuid4().hex}.chunks", 0, pack
                    target = files.open_output_stream(f"{base}/packs/{new}")
                source.seek(place)
                target.write(source.read(size))
                out["digest"].append(key)
                out["pack"].append(new)
                out["place"].append(at)
                out["packed"].append(size)
                at += size
            yield pa.RecordBatch.from_arrays([pa.array(out["digest"], pa.binary()), pa.array(out["pack"], pa.string()), pa.array(out["place"], pa.int64()), pa.array(out["packed"], pa.int64())], names=list(out))
        if target is not None:
            target.close()

    owned = owners.select("digest", "pack", "place", "packed").repartition(partitions(spark), "pack").sortWithinPartitions("pack", "place")
    index = materialize(owned.mapInArrow(tidy(compact), "digest binary, pack string, place long, packed long"), "index")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if files.get_file_info(f"{base}/packs/{name}").type == pafs.FileType.File:
                    files.delete_file(f"{base}/packs/{name}")
            yield batch

    spooled.select("pack").distinct().mapInArrow(tidy(drop), "pack string").write.format("noop").mode("overwrite").save()

    # recipes, in ascending document order, with the ids before each document
    ordered = spooled.select("doc_id", "n_tokens", "root", "chunks", "sizes").repartitionByRange(partitions(spark), doc_key(), "root").sortWithinPartitions(doc_key(), "root").withColumn("part", F.spark_partition_id())
    recipes = materialize(ordered.withColumn("row", F.monotonically_increasing_id()), "recipes")
    manifests = materialize(_fold(recipes), "manifest")
    return {"root": root, "width": width, "recipes": recipes, "index": index, "manifest": manifests}


def read_store(store: dict[str, DataFrame | str | int], cached_mb: int = 48) -> DataFrame:
    """Reconstruct every document from its recipe and the packs: doc_id, start, n_tokens, ids_crc32, root, verified.

    Documents are dealt by the pack that most of their first chunk's neighbours share, and read in the order of their
    places there, so that a task reads a pack almost in sequence; chunks of other packs go through a bounded cache.
    verified: each chunk's digest and the document's Merkle root agree with the recipe, and the counts and the Merkle root
    folded again over the recipe's part agree with the manifest. A chunk that the index lacks leaves its document unverified.
    """
    spark = store["recipes"].sparkSession
    root, form = store["root"], f"<u{store['width']}"
    recipes = store["recipes"]
    each = recipes.select("row", F.posexplode("sizes").alias("i", "size"), "chunks").select("row", "i", F.expr(f"substring(chunks, i * {DIGEST} + 1, {DIGEST})").alias("digest"))
    placed = each.join(store["index"], "digest", "left").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "digest", "pack", "place", "packed"))).alias("c"))
    before = Window.orderBy("part")
    again = _fold(recipes).select("part", F.struct("ids", "docs", "root").alias("now"))
    listed = store["manifest"].join(again, "part", "left").withColumn("sound", F.col("now").eqNullSafe(F.struct("ids", "docs", "root")))
    offsets = listed.select("part", "sound", F.coalesce(F.sum("ids").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(offsets, "offsets")
    starts = recipes.select("row", "doc_id", "n_tokens", "root", "part", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("within")).join(F.broadcast(offsets) if offsets.count() < 100_000 else offsets, "part", "left")
    rows = starts.join(placed, "row").select("doc_id", (F.col("part_start") + F.col("within")).alias("start"), "n_tokens", "root", F.coalesce("sound", F.lit(False)).alias("sound"), "c")
    dealt = rows.withColumn("home", F.col("c")[0]["pack"]).withColumn("at", F.col("c")[0]["place"]).repartition(partitions(spark), "home", F.floor(F.col("at") / (8 << 20))).sortWithinPartitions("home", "at")
    flat = dealt.select("doc_id", "start", "n_tokens", "root", F.col("c.digest").alias("digests"), F.col("c.pack").alias("packs"), F.col("c.place").alias("places"), F.col("c.packed").alias("packed"), "sound")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(root)
        opened: OrderedDict = OrderedDict()
        cache: OrderedDict[bytes, bytes] = OrderedDict()
        held, unpack = 0, zstandard.ZstdDecompressor()

        def pack_file(name: str):
            if name not in opened:
                if len(opened) >= 16:
                    opened.popitem(last=False)[1].close()
                opened[name] = files.open_input_file(f"{base}/packs/{name}")
            opened.move_to_end(name)
            return opened[name]

        for batch in batches:
            out = []
            for doc, start, n, want, digests, packs, places, packed, sound in zip(*(batch.column(k).to_pylist() for k in range(9))):
                leaves, crc, got, i = [], 0, 0, 0
                while i < len(digests):
                    if packs[i] is None:
                        raws, j = [], i + 1
                    elif digests[i] in cache:
                        cache.move_to_end(digests[i])
                        raws, j = [cache[digests[i]]], i + 1
                    else:  # neighbours in a pack are read at once
                        j = i + 1
                        while j < len(digests) and packs[j] == packs[i] and places[j] == places[j - 1] + packed[j - 1] and digests[j] not in cache:
                            j += 1
                        f = pack_file(packs[i])
                        f.seek(places[i])
                        data, raws = f.read(places[j - 1] + packed[j - 1] - places[i]), []
                        for k in range(i, j):
                            raw = unpack.decompress(data[places[k] - places[i] : places[k] - places[i] + packed[k]])
                            raws.append(raw)
                            cache[digests[k]] = raw
                            held += len(raw)
                        while held > cached_mb << 20:
                            held -= len(cache.popitem(last=False)[1])
                    for raw in raws:
                        leaves.append(digest(raw))
                        ids = np.frombuffer(raw, form).astype("<u4")
                        crc = zlib.crc32(ids.tobytes(), crc)
                        got += len(ids)
                    i = j
                out.append((doc, start, got, crc, want, sound and leaves == digests and merkle(leaves) == want and got == n))
            d, s, n_, c, r, v = zip(*out) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(n_, pa.int64()), pa.array(c, pa.int64()), pa.array(r, pa.binary()), pa.array(v, pa.bool_())], names=["doc_id", "start", "n_tokens", "ids_crc32", "root", "verified"])

    return flat.mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long, root binary, verified boolean")
