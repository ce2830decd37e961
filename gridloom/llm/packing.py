"""Best-fit packing with certified bin counts.

Token documents are cut into pieces and packed into sequences of `capacity` tokens. Pieces are dealt to groups of bounded
size by a hash; each group is packed by best-fit decreasing (BFD) and certified by a lower bound from dual-feasible
functions (DFF). Groups whose bin count is above their bound give their documents to an exchange pool, which is dealt anew
by another hash, to fewer and larger groups, and packed again; that repeats until every group is certified, the pool is one
group, an exchange wins nothing, or a few rounds are over. Only ids and lengths move.

Results for odd inputs: a null text is empty and is one piece that holds the end id alone; rows with equal ids are packed
on their own each; a null id stays null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, release, tidy, tune
from .tokens import END_ID, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all but the first are full."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, path: str, kind: str = "byte", capacity: int = 1024) -> DataFrame:
    """A row per piece of each document's ids (with the end id), with the CRC-32 of its ids."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, kind)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            rows: list[tuple] = []
            for doc, data in zip(ids, enc.encode(texts)):
                data += end
                rows += [(doc, k, s, n, zlib.crc32(data[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(data) // 4, capacity))]
            d, p, s, n, c = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), PIECES)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the sum bound and of two families of dual-feasible functions over the size histogram."""
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    # f_e: sizes above C - e count as C, sizes below e as 0
    below = np.concatenate([[0], np.cumsum(count * x)])  # below[i]: tokens in sizes < i
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])  # above[i]: pieces of size >= i
    e = np.arange(1, capacity // 2 + 1)
    total = above[capacity - e + 1] * capacity + below[capacity - e + 1] - below[e]
    best = max(best, int((-(-total // capacity)).max(initial=0)))
    for k in range(1, 65):  # u_k: multiples of C / (k + 1) keep their size, others round down to multiples of C / k
        scaled = (k + 1) * x
        num = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)  # u_k(x) * k
        best = max(best, -(-int((count * num).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece and the load of each bin; open bins are kept by free space, so a step costs no search over bins."""
    order = np.argsort(-sizes, kind="stable")
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, loads = 0, []  # spaces: bit s is set if a bin with s free tokens exists
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i in order.tolist():
        n = int(sizes[i])
        fit = spaces >> n
        if fit:
            s = n + (fit & -fit).bit_length() - 1
            b = free[s].pop()
            if not free[s]:
                spaces &= ~(1 << s)
        else:
            b, s = len(loads), capacity
            loads.append(0)
        bins[i], offsets[i] = b, loads[b]
        loads[b] += n
        left = s - n
        if left:
            free[left].append(b)
            spaces |= 1 << left
    return bins, offsets, np.array(loads, np.int64)


def _round(items: DataFrame, groups: int, salt: int, capacity: int) -> DataFrame:
    """items (uid, length) -> uid, length, grp, bin, offset, load, gap; gap: bins of the group above its bound."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        sizes = pdf["length"].to_numpy()
        bins, offsets, loads = best_fit_decreasing(sizes, capacity)
        return pdf.assign(bin=bins, offset=offsets, load=loads[bins], gap=len(loads) - lower_bound(sizes, capacity))

    dealt = items.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(groups)).cast("int"))
    return dealt.groupBy("grp").applyInPandas(pack, "uid long, length long, grp int, bin long, offset long, load long, gap long")


def best_fit_pack(pieces: DataFrame, capacity: int = 1024, group_pieces: int = 100_000, rounds: int = 4) -> DataFrame:
    """pieces (length, any other columns) -> the same rows with sequence_id and offset.

    group_pieces bounds what one task packs; it doubles with each of the few later rounds.
    """
    spark = pieces.sparkSession
    kept = materialize(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = kept.where(F.col("length") >= capacity).withColumn("sequence_id", F.col("uid") * 8).withColumn("offset", F.lit(0).cast("long"))
    pool = kept.where(F.col("length") < capacity).select("uid", "length")
    n = pool.count()
    groups, done, before = max(1, -(-n // group_pieces)), None, None
    for k in range(rounds):
        packed = materialize(_round(pool, groups, k, capacity), "packed")
        placed = packed.select("uid", ((F.col("grp").cast("long") * F.lit(1 << 32) + F.col("bin")) * 8 + (k + 1)).alias("sequence_id"), "offset", (F.col("gap") > 0).alias("open"))
        is_open = F.col("gap") > 0
        state = packed.agg(F.count_if(is_open).alias("n"), F.count_if(is_open & (F.col("offset") == 0)).alias("bins"), F.count_if(F.col("offset") == 0).alias("all_bins")).first()
        last = groups == 1 or not state["n"] or k == rounds - 1 or before is not None and state["all_bins"] >= before
        keep = (placed if last else placed.where(~F.col("open"))).select("uid", "sequence_id", "offset")
        done = keep if done is None else done.unionByName(keep)
        if last:
            break
        before = state["bins"]
        pool = packed.where("gap > 0").select("uid", "length")
        groups = max(1, -(-state["n"] // (group_pieces << (k + 1))))
    release(spark)
    rest = kept.where(F.col("length") < capacity).join(done, "uid")
    return full.unionByName(rest).drop("uid")


def pack_documents(docs: DataFrame, path: str, kind: str = "byte", capacity: int = 1024) -> DataFrame:
    """documents -> doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    packed = best_fit_pack(token_pieces(docs, path, kind, capacity), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
