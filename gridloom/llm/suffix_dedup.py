"""Removal of byte strings that occur earlier in the corpus, by suffix order and longest-previous-factor (LPF) values.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a document with a smaller id, or earlier
in the same document. Strings never cross documents and are judged on the input.

A suffix array of a whole corpus can't be cut into tasks, so suffixes are first brought together where they can match:
1. Winnowing picks anchors (k-byte strings) so that every string of `length` bytes holds one, and equal strings hold the
   same ones. An anchor's context is all bytes that strings of `length` with this anchor can reach.
2. Anchors meet by their hash. Of equal contexts all but the earliest document's are removable as a whole. An anchor
   whose contexts differ is left open for the first document of each context.
3. Open contexts meet by anchor, and a suffix array over each bundle (prefix doubling to depth `length`) gives the previous
   smaller position of every suffix in suffix order; LPF >= length marks the later copy. Anchors that very many documents
   or contexts share are not brought to one task: their strings are grouped by hash instead, which combines before the shuffle.
Exact copies of a document are settled by a hash of the whole text.

Results for odd inputs: null texts are empty; texts shorter than `length` keep all bytes; rows with equal ids stand at
the same place of the order, so neither removes from the other: a row is known by its id and its text, and rows that are
equal in both lose the same; null ids come first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, aside, distilled, doc_key, frequent_keys, materialize, mix, partitions, release, sliding, text_bytes, tidy, tune

COVERED, OPEN, OPEN_FREQUENT, WHOLE = 0, 1, 2, 3


def anchors(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, RollingHash] | None:
    """(places, hashes, context hashes) of the anchors of a text: the k-byte strings of least hash in some window of `length` bytes."""
    n = len(data)
    if n < length:
        return None
    roll, width = RollingHash(data), length - k + 1
    h = roll.windows(k)
    least = sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(sliding(np.concatenate([pad, least, pad]), width, np.maximum) == h)
    start, end = np.maximum(at - (length - k), 0), np.minimum(at + length, n)
    return at, h[at], roll.ranges(start, end) ^ mix((at - start).astype(np.uint64)), roll


def _code(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (h ^ mix(c + np.uint64(1))).view(np.int64)


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first `depth` bytes (shorter at the end), equal ones equal: prefix doubling from eight bytes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : n + i]

    def ranked(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        s = key[order]
        out = np.empty(n, np.uint64)
        out[order] = np.cumsum(np.concatenate([[True], s[1:] != s[:-1]])).astype(np.uint64)
        return out

    rank, have = ranked(key), min(8, depth)
    while have < depth:
        step = min(have, depth - have)
        other = np.zeros(n, np.uint64)
        other[: n - step] = rank[step:]
        rank, have = ranked(rank << np.uint64(32) | other), have + step
    return rank


def earlier_match(text: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int, owner: np.ndarray | None = None) -> np.ndarray:
    """For suffixes at `starts` (each with `length` bytes left) of places `order`: whether LPF >= length.

    Suffixes are sorted by rank, then place; the previous smaller place in suffix order with the same first `length` bytes
    is then among the entries before, the least of its run at the run's head. With owners (rows), an order is a document's
    rank << 40 | place, and an entry of the same document matches only if it has the same owner.
    """
    rank = suffix_ranks(text, length)[starts]
    at = np.lexsort((order, rank) if owner is None else (order, owner, order >> 40, rank))
    r, o = rank[at], order[at]
    head = np.concatenate([[True], r[1:] != r[:-1]])
    first = o[np.maximum.accumulate(np.where(head, np.arange(len(r)), 0))]
    out = np.empty(len(r), bool)
    if owner is None:
        out[at] = o > first
    else:
        w = owner[at]
        own = head | np.concatenate([[True], w[1:] != w[:-1]])
        out[at] = (o >> 40 > first >> 40) | (o > o[np.maximum.accumulate(np.where(own, np.arange(len(r)), 0))])
    return out


def _merge(spans: np.ndarray) -> np.ndarray:
    """The union of [start, end) rows; touching ones join."""
    if len(spans) == 0:
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    i = np.flatnonzero(new)
    return np.stack([spans[i, 0], reach[np.concatenate([i[1:] - 1, [len(spans) - 1]])]], 1)


def _row_key(length: int, clash: bool) -> Column:
    """With the id, what tells rows apart: a hash of the text where an id has several texts, else whether the text is long enough to have spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.xxhash64(text) if clash else F.when(F.octet_length(text) >= length, 0).otherwise(1).cast("long")


def _rows(docs: DataFrame, length: int, clash: bool = True) -> DataFrame:
    return docs.select(doc_key().alias("d"), F.col("text").cast("string").alias("text"), _row_key(length, clash).alias("t"))


def _text_hash(data: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _survey(docs: DataFrame, length: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(d, text hash, row key t) of each document that is long enough, and each task's counts of anchors met more than a few times, by documents and contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counts() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            keys, n = keys[n > 3], n[n > 3]
            none = pa.nulls(len(keys), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["d", "hash", "t", "key", "n"])

        for batch in batches:
            d, hashes, ts = [], [], []
            for doc, data, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                found = anchors(data, length, k)
                if found is not None:
                    d.append(doc)
                    hashes.append(_text_hash(data))
                    ts.append(t)
                    # once for each context, as a bundle gets it: one document may hold very many of an anchor
                    held.append(found[1][np.unique(_code(found[1], found[2]), return_index=True)[1]])
            none = pa.nulls(len(d), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(hashes, pa.int64()), pa.array(ts, pa.int64()), none, none], names=["d", "hash", "t", "key", "n"])
            if sum(map(len, held)) > 4_000_000:
                yield counts()
                held = []
        if held:
            yield counts()

    both = materialize(_rows(docs, length).mapInArrow(tidy(run), "d long, hash long, t long, key long, n long"), "survey")
    return both.where("d IS NOT NULL").select("d", "hash", "t"), both.where("d IS NULL").select("key", "n")


def _anchor_rows(docs: DataFrame, frequent: np.ndarray, length: int, k: int, clash: bool) -> DataFrame:
    """key, context, d, salt, t: once per document; exact copies of an earlier document that the task has met give none."""
    held = docs.sparkSession.sparkContext.broadcast(np.sort(frequent.view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = held.value, {}
        for batch in batches:
            keys, contexts, ds, salts, ts = [], [], [], [], []
            for doc, data, row in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                if len(data) < length:
                    continue
                t = _text_hash(data)
                if seen.get(t, doc) < doc:
                    continue
                if len(seen) < 1 << 20:
                    seen[t] = doc
                _, h, c, _ = anchors(data, length, k)
                _, once = np.unique(_code(h, c), return_index=True)
                h, c = h[once], c[once]
                salt = np.zeros(len(h), np.int64)
                if len(often):
                    hot = often[np.minimum(np.searchsorted(often, h), len(often) - 1)] == h
                    salt[hot] = c[hot].view(np.int64) | 1
                keys.append(h.view(np.int64))
                contexts.append(c.view(np.int64))
                ds.append(np.full(len(h), doc, np.int64))
                salts.append(salt)
                ts.append(np.full(len(h), row, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, contexts, ds, salts, ts)], names=["key", "context", "d", "salt", "t"])

    return _rows(docs, length, clash).mapInArrow(tidy(run), "key long, context long, d long, salt long, t long")


def _whole_groups(batches: Iterator[pa.RecordBatch], key: int, rows: int = 250_000, size: int = 2 << 20) -> Iterator[pa.Table]:
    """Rows sorted by a key column, in tables that hold whole groups of about so many rows or bytes."""
    held: list[pa.RecordBatch] = []
    n = b = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        n, b = n + batch.num_rows, b + batch.nbytes
        if n >= rows or b >= size:
            table = pa.Table.from_batches(held)
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).combine_chunks().to_batches()
                n, b = sum(x.num_rows for x in held), sum(x.nbytes for x in held)
    if held:
        yield pa.Table.from_batches(held)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors sorted by (key, salt, context, d): which are covered, which open."""
    for table in _whole_groups(batches, 0):
        key, context, d, salt, t = (table.column(i).to_numpy() for i in range(5))
        new_key = np.concatenate([[True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
        new = new_key | np.concatenate([[True], context[1:] != context[:-1]])
        group = np.cumsum(new_key) - 1
        differ = np.bincount(group[new]) > 1
        least = d[np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))]
        flag = np.where(d > least, COVERED, np.where(salt != 0, OPEN_FREQUENT, np.where(differ[group], OPEN, -1)))
        # of a first context one row per document is enough; d == least more than once: rows with equal ids
        keep = flag >= 0
        code = _code(key.view(np.uint64), context.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(d[keep]), pa.array(t[keep]), pa.array(code[keep]), pa.array(flag[keep].astype(np.int32))], names=["d", "t", "code", "flag"])


def _resolve(texts: DataFrame, length: int, k: int) -> DataFrame:
    """d, text, codes by flag, t -> kind, d, t, key, s, e, context: spans (kind 0), open contexts (1) and strings of frequent anchors (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, n = [], 0
            ends, pairs = batch.column(2).offsets.to_numpy(), batch.column(2).values
            codes, kinds = (pairs.field(c).to_numpy() for c in ("code", "flag"))
            for doc, data, t, a, b in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(3).to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                if len(data) < length:
                    continue
                if (kinds[a:b] == WHOLE).any():
                    found = [(0, None, np.zeros(1, np.int64), np.full(1, len(data)), None)]
                else:
                    found = strings(data, {f: codes[a:b][kinds[a:b] == f] for f in (COVERED, OPEN, OPEN_FREQUENT)})
                for kind, key, start, end, context in found:
                    for i in range(0, len(start), 20_000):
                        j = slice(i, i + 20_000)
                        out.append((kind, doc, t, None if key is None else key[j], start[j], end[j], None if context is None else context[j]))
                        n += len(start[j])
                        if n > 20_000:
                            yield rows(out)
                            out, n = [], 0
            if n:
                yield rows(out)

    def strings(data: np.ndarray, flags: dict[int, np.ndarray]) -> list[tuple]:
        """kind, key, start, end (-1: no answer wanted), context of one document, as arrays."""
        at, h, c, roll = anchors(data, length, k)
        code = _code(h, c)
        start, end = np.maximum(at - (length - k), 0), np.minimum(at + length, len(data))
        _, once = np.unique(code, return_index=True)
        first = np.zeros(len(at), bool)
        first[once] = True
        covered = ~first | np.isin(code, flags[COVERED])
        spans = _merge(np.stack([start[covered], end[covered]], 1))
        out: list[tuple] = [(0, None, spans[:, 0], spans[:, 1], None)]
        open_ = np.flatnonzero(first & np.isin(code, flags[OPEN]))
        out.append((1, h[open_].view(np.int64), start[open_], end[open_], [data[i:j].tobytes() for i, j in zip(start[open_].tolist(), end[open_].tolist())]))
        often = np.flatnonzero(first & np.isin(code, flags[OPEN_FREQUENT]))
        if len(often):
            w = np.unique(np.concatenate([np.arange(start[j], end[j] - length + 1) for j in often]))
            wh = roll.ranges(w, w + length).view(np.int64)
            _, once = np.unique(wh, return_index=True)
            again = np.ones(len(w), bool)
            again[once] = False
            twice = _merge(np.stack([w[again], w[again] + length], 1))
            out.append((0, None, twice[:, 0], twice[:, 1], None))
            # a string whose bytes all go already is still the earliest of its kind for others, but needs no answer
            w, wh = w[once], wh[once]
            into = np.searchsorted(spans[:, 0], w, "right") - 1
            gone = (into >= 0) & (spans[np.maximum(into, 0), 1] >= w + length) if len(spans) else np.zeros(len(w), bool)
            out.append((2, wh, w, np.where(gone, -1, w + length), None))
        return [o for o in out if len(o[2])]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        sizes = [len(o[4]) for o in out]
        whole = lambda i, kind: pa.array(np.repeat(np.array([o[i] for o in out], np.int64), sizes), pa.int64()).cast(kind)
        end = np.concatenate([o[5] for o in out]).astype(np.int64)
        key = pa.concat_arrays([pa.nulls(m, pa.int64()) if o[3] is None else pa.array(o[3], pa.int64()) for o, m in zip(out, sizes)])
        context = pa.concat_arrays([pa.nulls(m, pa.binary()) if o[6] is None else pa.array(o[6], pa.binary()) for o, m in zip(out, sizes)])
        start = pa.array(np.concatenate([o[4] for o in out]).astype(np.int64))
        return pa.RecordBatch.from_arrays([whole(0, pa.int32()), whole(1, pa.int64()), whole(2, pa.int64()), key, start, pa.array(end, pa.int64(), mask=end < 0), context], names=["kind", "d", "t", "key", "s", "e", "context"])

    return texts.mapInArrow(tidy(run), "kind int, d long, t long, key long, s long, e long, context binary")


def _bundles(length: int):
    """Open contexts sorted by anchor -> spans (d, t, s, e) of strings that occur earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 0, size=1 << 18):
            d, s, t = table.column(1).to_numpy(), table.column(2).to_numpy(), table.column(4).to_numpy()
            parts = text_bytes(table.column(3))
            sizes = np.array([len(x) for x in parts])
            text = np.concatenate(parts)
            base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            many = sizes - length + 1
            which = np.repeat(np.arange(len(parts)), many)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            starts, place = base[which] + inner, s[which] + inner
            # contexts none of whose strings has an equal in the bundle need no suffix array
            h = RollingHash(text).ranges(starts, starts + length)
            _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
            alive = np.zeros(len(parts), bool)
            alive[which[count[inverse] > 1]] = True
            if not alive.any():
                continue
            live = alive[which]
            keep = np.repeat(alive, sizes)
            shift = np.cumsum(np.where(alive, 0, sizes)) - np.where(alive, 0, sizes)
            text, starts, which, place = text[keep], (starts - shift[which])[live], which[live], place[live]
            rank_d = np.unique(d, return_inverse=True)[1]
            order = rank_d[which].astype(np.int64) << 40 | place
            owner = np.unique(mix(rank_d.astype(np.uint64)) ^ t.view(np.uint64), return_inverse=True)[1][which] if t.any() else None
            hit = earlier_match(text, starts, order, length, owner)
            w, p = which[hit], place[hit]
            if len(w) == 0:
                continue
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (p[1:] != p[:-1] + 1)])
            i = np.flatnonzero(new)
            last = np.concatenate([i[1:] - 1, [len(w) - 1]])
            yield pa.RecordBatch.from_arrays([pa.array(d[w[i]]), pa.array(t[w[i]]), pa.array(p[i]), pa.array(p[last] + length)], names=["d", "t", "s", "e"])

    return run


def repeated_spans(docs: DataFrame, length: int = 100, k: int = 40, frequent: int = 1 << 16, often: int = 2048) -> tuple[DataFrame, bool]:
    """documents -> d, t, s, e (t: the row key): byte spans (they may overlap) whose union is what goes.

    A bundle holds the open contexts of one anchor, up to about `often` of them (a third of a megabyte); `frequent` bounds the
    list of anchors beyond that, which is broadcast. Both spread work and bound no result.
    Also returns whether an id has several texts.
    """
    spark = docs.sparkSession
    tune(spark)
    n = partitions(spark)
    survey, counts = _survey(docs, length, k)
    clash = not survey.groupBy("d").agg(F.min("hash").alias("h0"), F.max("hash").alias("h1")).where("h0 < h1").isEmpty()
    held = frequent_keys(counts, frequent, often)
    copies = materialize(survey.groupBy("hash").agg(F.min("d").alias("d0"), F.max("d").alias("d1")).where("d0 < d1").select("hash", "d0"), "copies")
    whole = survey.join(copies, "hash").where("d > d0").select("d", F.col("t") if clash else F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("code"), F.lit(WHOLE).alias("flag"))
    met = _anchor_rows(docs, held, length, k, clash).repartition(n, "key", "salt").sortWithinPartitions("key", "salt", "context", "d")
    judged = met.mapInArrow(tidy(_judge), "d long, t long, code long, flag int")
    listed = judged.unionByName(whole.distinct()).groupBy("d", "t").agg(F.collect_list(F.struct("code", "flag")).alias("codes"))
    found = materialize(_resolve(_rows(docs, length, clash).join(listed.withColumnsRenamed({"d": "ld", "t": "lt"}), (F.col("d") == F.col("ld")) & (F.col("t") == F.col("lt")), "left").select("d", "text", "codes", "t"), length, k), "resolved")
    release(spark)
    open_ = found.where("kind = 1").select("key", "d", "s", "context", "t").repartition(n, "key").sortWithinPartitions("key")
    matched = open_.mapInArrow(tidy(_bundles(length)), "d long, t long, s long, e long")
    strings = found.where("kind = 2").select("key", "d", "t", "s", "e")
    again = materialize(strings.groupBy("key").agg(F.min("d").alias("d0"), F.max("d").alias("d1")).where("d0 < d1").select("key", "d0"), "again")
    later = strings.where("e IS NOT NULL").join(again, "key").where("d > d0").select("d", "t", "s", "e")
    return found.where("kind = 0").select("d", "t", "s", "e").unionByName(matched).unionByName(later), clash


def remove_repeats(docs: DataFrame, length: int = 100, digest_only: bool = False, **options: int) -> DataFrame:
    """documents -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the text left, with what a cut made undecodable dropped), and the other columns of `docs`.

    digest_only leaves out kept and the other columns. Other columns may have any name; those named like an output give way to it.
    """
    inner, names = aside(docs, ["doc_id", "text"])
    clashes: list[bool] = []

    def found() -> DataFrame:
        rows, clash = repeated_spans(inner, length, **options)
        clashes.append(clash)
        return rows

    spans, clash = distilled(docs.sparkSession, found, "spans"), clashes[0]
    release(docs.sparkSession)
    listed = spans.groupBy(F.col("d").alias("_ld"), F.col("t").alias("_lt")).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    others = [] if digest_only else [c for c in docs.columns if c not in ("doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]
    own = [names[c] for c in others]
    rows = inner.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), doc_key().alias("_d"), _row_key(length, clash).alias("_t"), *own)
    joined = rows.join(listed, (F.col("_d") == F.col("_ld")) & (F.col("_t") == F.col("_lt")), "left").select("doc_id", "text", "spans", *own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, runs, sha, kept = [], [], [], [], []
            spans = batch.column(2)
            for i, data in enumerate(text_bytes(batch.column(1))):
                listed = spans[i].as_py() or []
                cut = np.minimum(_merge(np.array([(x["s"], x["e"]) for x in listed], np.int64).reshape(-1, 2)), len(data))
                at = [0, *cut.ravel().tolist(), len(data)]
                left = b"".join(data[a:b].tobytes() for a, b in zip(at[::2], at[1::2]))
                n.append(len(data))
                gone.append(len(data) - len(left))
                runs.append(len(cut))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(None if digest_only else left.decode("utf-8", "ignore"))
            longs = [pa.array(x, pa.int64()) for x in (n, gone, runs)]
            columns, names = [batch.column(0), *longs, pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if not digest_only:
                columns, names = [*columns, pa.array(kept, pa.string()), *(batch.column(3 + j) for j in range(len(others)))], [*names, "kept", *others]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if not digest_only:
        kinds = dict(docs.dtypes)
        schema += ", kept string" + "".join(f", `{c}` {kinds[c]}" for c in others)
    return joined.mapInArrow(tidy(run), schema)
