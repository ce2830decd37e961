"""Jaccard self-join on word n-grams by vertical partitioning.

Every document is the set of its distinct n-grams, as 64-bit hashes; documents with equal sets are one class.
One global order of n-grams (rare ones first, by a count sketch of fixed size, then by hash) is cut at pivots into fragments.
Each fragment of a class counts its own overlap with that of a candidate partner, and the sum per pair decides.

Candidates: linked classes share an n-gram among the first of each in the order (prefix filter). The classes of such an
n-gram are a group. First each group's poles (its most central class, the least and the greatest) meet the others, and what
links is joined up as components. Groups that still lie in several components are settled exactly:
- of up to `direct` classes: the pairs across components, with the count of prefix n-grams that each pair shares;
- larger ones by their differences to the group's central class p. S(x) = x symmetric difference p has |x sym.diff. y| =
  |S(x) sym.diff. S(y)|, so S(x) and S(y) of a link share a known least number t of n-grams. What all copies of p share is
  in no S. Two classes that both link to p are one component; so in any pair that is open one, x, does not, which makes t
  more than half of S(y). A prefix filter on S, n-grams that p lacks first, then finds the pairs: rows in proportion to
  the group's differences, not to its pairs.
Pairs that counts, sizes, parity maps or the triangle inequality rule out need no sets; all others are counted, so no link between
different components is lost.

Results for odd inputs: a text with no words (or null) has no n-grams, is linked with nothing and is its own component;
fewer than n words are one n-gram; equal ids count as one node that has each row's links; null ids are components of their
own (null) and never a component's id while another member has one; texts of any length are read whole, a text's set is one
row; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import RollingHash, distilled, doc_key, materialize, mix, partitions, release, text_bytes, tidy, tune
from .components import components

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
FRAGMENTS = 4
#: The count sketch has 2^SKETCH buckets, whatever the corpus; they are sent in pieces of 2^PIECE.
SKETCH, PIECE = 21, 14
#: Least bits of a set's parity map, as 64-bit numbers; a larger set has the power of two that gives each n-gram four or more.
MAP = 2048
#: Bytes of maps or sets that pairs are met with in one go; what is more follows in further goes, so scratch is bounded however many pairs there are.
HELD = 1 << 30


def shingle_sets(texts: list[np.ndarray], n: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of UTF-8 bytes, for each text; A-Z are lower-cased, words are [^\\x20\\x09-\\x0D]+."""
    out: list[np.ndarray] = []
    for group in _groups(texts):
        sizes = np.array([len(x) + 1 for x in group])
        data = np.full(int(sizes.sum()), 0x20, np.uint8)
        ends = np.cumsum(sizes)
        for x, end in zip(group, ends.tolist()):
            data[end - 1 - len(x) : end - 1] = x
        word = _WORD[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word]).view(np.int8)))  # each text ends with a space, so words do not join
        start, end = edge[::2], edge[1::2]
        h = RollingHash(_LOWER[data]).ranges(start, end)
        at = np.searchsorted(start, np.concatenate([[0], ends]))  # words of text i: at[i] to at[i + 1]
        total = h.copy()
        for k in range(1, min(n, len(h))):  # total[i]: of the n words from i, where there are so many
            total[: len(h) - k] = mix(total[: len(h) - k] + np.uint64(0x9E3779B97F4A7C15)) + h[k:]
        whole = mix(total ^ np.uint64(n))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            m = b - a
            if m >= n:
                s = whole[a : b - n + 1].copy()
                s.sort()
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif m:
                t = h[a : a + 1].copy()
                for k in range(1, m):
                    t = mix(t + np.uint64(0x9E3779B97F4A7C15)) + h[a + k : a + k + 1]
                out.append(mix(t ^ np.uint64(m)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _groups(texts: list[np.ndarray], size: int = 1 << 18) -> Iterator[list[np.ndarray]]:
    """Runs of texts of about so many bytes, which stay in the processor's cache."""
    group, held = [], 0
    for x in texts:
        group.append(x)
        held += len(x)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def shingles(data: np.ndarray, n: int = 5) -> np.ndarray:
    return shingle_sets([data], n)[0]


def set_digest(s: np.ndarray) -> int:
    """A 63-bit digest of a set of hashes."""
    if len(s) == 0:
        return -1
    with np.errstate(over="ignore"):
        a = mix(s + np.uint64(0x1234567)).sum() + mix(s * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)).sum() * np.uint64(0x165667B19E3779F9)
    return int(mix(np.array([a + np.uint64(len(s))], np.uint64))[0] >> np.uint64(1))


def _need(n: int, percent: int) -> int:
    """The least overlap of a set of n with any set that it links to."""
    return -(-n * percent // 100)


def _docs(docs: DataFrame) -> DataFrame:
    """doc_id, text, d and h: what a text is found by again, its id as a sort key and a hash."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), doc_key().alias("d"), F.xxhash64(text).alias("h"))


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a, pa.int64())


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH)).astype(np.int64)


def _sets(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, d, h, n, class) of every document, and each task's bucket counts (piece, task, at, count)."""
    names = ["doc_id", "d", "h", "n", "class", "piece", "at", "count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        counts = np.zeros(1 << SKETCH, np.uint32)
        for batch in batches:
            sets = shingle_sets(text_bytes(batch.column(1)), n)
            sizes, classes, new = [len(s) for s in sets], [set_digest(s) for s in sets], []
            for s, c in zip(sets, classes):
                if len(s) and c not in seen:
                    new.append(s)
                    if len(seen) < 1 << 20:
                        seen.add(c)
            if new:
                counts += np.bincount(_bucket(np.concatenate(new)), minlength=1 << SKETCH).astype(np.uint32)
            none, lost = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), none, lost, lost], names=names)
        none, task = pa.nulls(1, pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int64())
        for piece in range(1 << SKETCH - PIECE):
            at, count = _pack(counts[piece << PIECE : piece + 1 << PIECE])
            if count:
                yield pa.RecordBatch.from_arrays([none, task, none, none, none, pa.array([piece], pa.int32()), pa.array([at], pa.binary()), pa.array([count], pa.binary())], names=names)

    both = materialize(_docs(docs).mapInArrow(tidy(run), "doc_id long, d long, h long, n long, class long, piece int, at binary, count binary"), "sets")
    return both.where("piece IS NULL").select("doc_id", "d", "h", "n", "class"), both.where("piece IS NOT NULL").select("piece", F.col("d").alias("task"), "at", "count")


def _pack(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Places and values of the counts above 0, in one byte each where they fit, else eight; no places where all values take less."""
    at = np.flatnonzero(counts).astype("<u2")
    small = not len(at) or counts.max() < 256
    if small and 3 * len(at) > len(counts):
        return b"", counts.astype("<u1").tobytes()
    return at.tobytes(), counts[at].astype("<u1" if small else "<u8").tobytes()


def _unpacked(at: bytes, count: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not at:
        return np.arange(len(count)), np.frombuffer(count, "<u1")
    return np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(count, "<u1" if 2 * len(count) == len(at) else "<u8")


def _levels(counts: DataFrame) -> tuple[np.ndarray, int]:
    """A level (uint8) for each bucket: 0 for what is within chance of the mean, then the logarithm of what exceeds it; and the count of n-grams that chance may hide.

    Counts are summed in tasks, first by piece and salt, then by piece; the driver gets 2^SKETCH numbers, whatever the corpus.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, at, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if piece not in held:
                    held[piece] = np.zeros(1 << PIECE, np.uint64)
                places, values = _unpacked(at, count)
                held[piece][places] += values
        for piece, total in held.items():
            at, count = _pack(total)
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([at], pa.binary()), pa.array([count], pa.binary())], names=["piece", "at", "count"])

    n, kind = partitions(counts.sparkSession), "piece int, at binary, count binary"
    salted = counts.repartition(n, "piece", F.pmod("task", F.lit(8))).select("piece", "at", "count").mapInArrow(tidy(add), kind)
    total = np.zeros(1 << SKETCH, np.float64)
    for row in salted.repartition(n, "piece").mapInArrow(tidy(add), kind).collect():
        places, values = _unpacked(row["at"], row["count"])
        total[places + (row["piece"] << PIECE)] = values
    mean = np.median(total)
    over = np.maximum(0, total - mean - 5 * np.sqrt(mean) - 4)
    return np.where(over > 0, 1 + np.log2(1 + over), 0).astype(np.uint8), int(8 * np.sqrt(mean))


def _order(s: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted hashes, and their levels in it: by level, then hash."""
    level = levels[_bucket(s)]
    at = np.argsort(level, kind="stable")
    return at, level[at]


def _prefixes(docs: DataFrame, n: int, percent: int, levels: Broadcast) -> DataFrame:
    """The first n-grams of each class: key, class, n, salt. A task gives a class once, however many copies it meets.

    salt is 0 but for frequent n-grams, whose rows it spreads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, classes, sizes, salts = [], [], [], []
            for s in shingle_sets(text_bytes(batch.column(0)), n):
                if not len(s) or (c := set_digest(s)) in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(c)
                take = len(s) - _need(len(s), percent) + 1
                at, level = _order(s, levels.value)
                keys.append(s[at[:take]])
                classes.append(np.full(take, c, np.int64))
                sizes.append(np.full(take, len(s), np.int64))
                salts.append(np.where(level[:take] > 0, c | 1, 0))
            if keys:
                yield pa.RecordBatch.from_arrays([_long(np.concatenate(x)) for x in (keys, classes, sizes, salts)], names=["key", "class", "n", "salt"])

    return _docs(docs).select("text").mapInArrow(tidy(run), "key long, class long, n long, salt long")


def _wholes(docs: DataFrame, n: int, wanted: DataFrame, sizes: DataFrame, few: int) -> DataFrame:
    """class, grams (the set) of the classes in `wanted`, once each, from one text of each; a small list is broadcast, else it is a shuffled join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(text_bytes(batch.column(1)), n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "grams"])

    places = materialize(sizes.join(wanted, "class", "left_semi").select("class", "at.d", "at.h"), "places")
    texts = _docs(docs).join(F.broadcast(places) if places.count() <= few else places, ["d", "h"]).select("class", "text")
    return texts.mapInArrow(tidy(run), "class long, grams binary").groupBy("class").agg(F.first("grams").alias("grams"))


def parity_map(s: np.ndarray) -> np.ndarray:
    """Of each of MAP or more buckets, whether it has an odd number of the set's hashes; maps differ in at most as many bits as the sets in n-grams.

    A map's halves, one over the other, are the map of half the bits, so maps of sets of any two sizes can be compared.
    """
    bits = max(MAP, 1 << (4 * len(s) - 1).bit_length())
    odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _cut(wholes: DataFrame, levels: Broadcast) -> DataFrame:
    """class, fragment, part, map: each set cut at the pivots of the global order; what frequent n-grams hold is the last fragment. Fragment -1 has the parity map."""
    pivots = np.array([k * (2**64 // (FRAGMENTS - 1)) for k in range(1, FRAGMENTS - 1)], np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, f, p, m = [], [], [], []
            for key, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = np.frombuffer(whole, np.uint64)
                often = levels.value[_bucket(s)] > 0
                rare = s[~often]
                at = [0, *np.searchsorted(rare, pivots).tolist(), len(rare)]
                c += [key] * (FRAGMENTS + 1)
                f += range(-1, FRAGMENTS)
                p += [None, *(rare[i:j].tobytes() for i, j in zip(at, at[1:])), s[often].tobytes()]
                m += [parity_map(s), *[None] * FRAGMENTS]
                if len(p) >= 512:
                    yield rows(c, f, p, m)
                    c, f, p, m = [], [], [], []
            if p:
                yield rows(c, f, p, m)

    def rows(c: list, f: list, p: list, m: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(f, pa.int32()), pa.array(p, pa.binary()), pa.array(m, pa.list_(pa.int64()))], names=["class", "fragment", "part", "map"])

    return materialize(wholes.mapInArrow(tidy(cut), "class long, fragment int, part binary, map array<long>").where("fragment < 0 OR length(part) > 0"), "fragments")


def _fits(percent: int) -> Column:
    """Sizes that a link allows."""
    return F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")


def _able(counted: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb, c: n-grams that both prefixes share) which may link by their sizes and that count.

    Up to the end of the prefix that ends first in the global order, the shared count is all of the overlap; what lies
    behind it is at most the rest of that document. A link needs percent * (na + nb) / (100 + percent) in all.
    """
    return counted.where(_fits(percent)).where(F.expr(f"c >= {_least_shared(percent)}")).select("a", "b", "na", "nb")


def _least_shared(percent: int) -> str:
    """SQL of the least count of n-grams that the prefixes of a link share."""
    least = f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}"
    rest = f"({percent} * greatest(na, nb) + 99) div 100 - 1"
    return f"({least} - ({rest}))"


def _across(small: DataFrame, listed: DataFrame, percent: int) -> DataFrame:
    """small (key, class, n, root, m: groups that lie in several components) and listed pairs -> the pairs across components that may link.

    A class's keys are ordered, those of large groups last. Of l keys that a pair shares, the first has l - 1 of either class
    behind it: a link is met at a key with so many behind it on both sides, so keys of large groups are met for few pairs, and
    a pair at few of its keys. What is met so (or listed) is then counted on all keys, a row per pair.
    """
    behind = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("m"), F.desc("key"))) - 1
    ranked = materialize(small.select("key", "class", "n", "root", behind.alias("behind")), "ranked")
    left, right = (ranked.select("key", F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("root").alias(f"r{x}"), F.col("behind").alias(f"behind_{x}")) for x in "ab")
    met = left.join(right, "key").where(F.expr(f"a < b AND ra <> rb AND least(behind_a, behind_b) >= {_least_shared(percent)} - 1") & _fits(percent))
    pairs = materialize(met.select("a", "b", "na", "nb", F.lit(0).cast("long").alias("c")).distinct().unionByName(listed).groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c")), "met")
    keys = materialize(ranked.groupBy("class").agg(F.collect_list("key").alias("keys")), "keys")

    def counted(some: DataFrame) -> DataFrame:
        both = some.join(keys.withColumnsRenamed({"class": "a", "keys": "ka"}), "a", "left").join(keys.withColumnsRenamed({"class": "b", "keys": "kb"}), "b", "left")
        return _able(both.withColumn("c", F.col("c") + F.when(F.expr("ka IS NOT NULL AND kb IS NOT NULL"), F.size(F.array_intersect("ka", "kb"))).otherwise(0)), percent)

    return _in_goes(pairs, F.lit(256), counted, "counted")


def _in_goes(pairs: DataFrame, held: Column, step: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """step (a row for a row) of all pairs (a, b), in as many goes as the bytes that they are met with call for: a go's shuffles are dropped before the next."""
    goes = -(-(pairs.agg(F.sum(held.cast("long"))).first()[0] or 0) // HELD)
    if goes < 2:
        return step(pairs)
    done = None
    for i in range(goes):
        one = materialize(step(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(goes)) == i)), name)
        done = one if done is None else done.unionByName(one)
        release(pairs.sparkSession)
    return done


def _screen(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) but those whose parity maps differ in more bits than a link's sets may differ in n-grams: a row per pair, no link lost."""
    maps = parts.where("fragment < 0").select("class", "map")
    words = "least(size(ma), size(mb))"
    folded = lambda m: f"CASE WHEN size({m}) = {words} THEN {m} ELSE transform(sequence(0, {words} - 1), j -> aggregate(sequence(j, size({m}) - 1, {words}), 0L, (t, i) -> t ^ {m}[i])) END"
    apart = f"aggregate(zip_with({folded('ma')}, {folded('mb')}, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)"

    def near(some: DataFrame) -> DataFrame:
        both = some.select("a", "b", "na", "nb").join(maps.withColumnsRenamed({"class": "a", "map": "ma"}), "a").join(maps.withColumnsRenamed({"class": "b", "map": "mb"}), "b")
        return both.where(F.expr(f"{100 + percent} * {apart} <= {100 - percent} * (na + nb)")).select("a", "b", "na", "nb")

    return materialize(_in_goes(pairs, F.expr(f"greatest(na, nb, {MAP // 8})"), near, "near"), "screened")


def _count(pairs: DataFrame, parts: DataFrame, percent: int, few: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link: overlaps counted fragment by fragment, summed per pair. Up to `few` pairs are broadcast to the parts of b."""

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            got = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(got, pa.int64())], names=["a", "b", "na", "nb", "overlap"])

    listed = _screen(pairs, parts, percent)
    parts = parts.where("fragment >= 0")
    a = parts.select(F.col("class").alias("a"), "fragment", F.col("part").alias("pa"))
    b = parts.select(F.col("class").alias("b"), "fragment", F.col("part").alias("pb"))

    def linked(some: DataFrame) -> DataFrame:
        met = b.join(F.broadcast(some) if some.count() <= few else some, "b").join(a, ["a", "fragment"]).select("a", "b", "na", "nb", "pa", "pb")
        summed = met.mapInArrow(tidy(overlap), "a long, b long, na long, nb long, overlap long").groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("o"))
        return summed.where(F.expr(f"100 * o >= {percent} * (na + nb - o)")).select("a", "b")

    return _in_goes(listed, 8 * F.col("nb"), linked, "linked")


def _differences(coded: DataFrame, wholes: DataFrame, percent: int, levels: Broadcast) -> DataFrame:
    """coded (x, p, root of x) with their sets -> p, x, root, n, k = |S(x)|, short, long: prefixes of S(x), as bytes; long is null if x links to p.

    short holds an n-gram of S(y) for each link of x to a y that does not link to p; long is the prefix that such a y needs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = 100 - percent
        for batch in batches:
            out: list[tuple] = []
            for x, p, root, s, q in zip(*(batch.column(i).to_pylist() for i in range(5))):
                s, q = np.frombuffer(s, np.uint64), np.frombuffer(q, np.uint64)
                new, gone = np.setdiff1d(s, q, assume_unique=True), np.setdiff1d(q, s, assume_unique=True)
                e = np.concatenate([new[_order(new, levels.value)[0]], gone[_order(gone, levels.value)[0]]])
                k = len(e)
                links = (100 + percent) * k <= spread * (len(s) + len(q))
                # |S(x) and S(y)| = (|S(x)| + |S(y)| - |x sym.diff. y|) / 2, and |x sym.diff. y| <= spread / (100 + percent) * (nx + ny)
                far = len(s) * spread // percent  # a partner's S is shorter by this at most
                t = max(((100 + percent) * k + spread * (len(q) - len(s))) // (2 * (100 + percent)) + 1, k - far)
                out.append((p, x, root, len(s), k, e[: max(0, k - t + 1)].tobytes(), None if links else e[: far + 1].tobytes()))
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["p", "x", "root", "n", "k", "short", "long"])

    sx, sp = wholes.select(F.col("class").alias("x"), F.col("grams").alias("gx")), wholes.select(F.col("class").alias("p"), F.col("grams").alias("gp"))
    release(coded.sparkSession)
    both = coded.join(sx, "x").join(sp, "p").select("x", "p", "root", "gx", "gp")
    return materialize(both.mapInArrow(tidy(run), "p long, x long, root long, n long, k long, short binary, long binary"), "differences")


def _unpack(rows: DataFrame, what: str) -> DataFrame:
    """p, x, root, n, k, rest (n-grams of S(x) from this one on), far, e: a row per n-gram of the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(b, np.uint64) for b in batch.column(5).to_pylist()]
            many = np.array([len(p) for p in parts], np.int64)
            p, x, root, n, k = (np.repeat(batch.column(i).to_numpy(), many) for i in range(5))
            far = np.repeat(batch.column(6).to_numpy(zero_copy_only=False), many)
            at = np.arange(len(p)) - np.repeat(np.cumsum(many) - many, many)
            e = np.concatenate(parts) if len(parts) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*map(_long, (p, x, root, n, k, k - at)), pa.array(far), _long(e)], names=["p", "x", "root", "n", "k", "rest", "far", "e"])

    return rows.select("p", "x", "root", "n", "k", what, F.col("long").isNotNull().alias("far")).where(F.col(what).isNotNull()).mapInArrow(tidy(run), "p long, x long, root long, n long, k long, rest long, far boolean, e long")


def _by_differences(open_: DataFrame, wholes: DataFrame, percent: int, levels: Broadcast) -> tuple[DataFrame, DataFrame]:
    """open_ (x, p, root: classes of large groups with the group's central class) -> links (a, b) with p, and candidate pairs (a, b, na, nb).

    A link's first shared n-gram in the order leaves it no more than what follows in the shorter rest; a pair without such an n-gram is none.
    """
    coded = _differences(open_, materialize(wholes, "wholes"), percent, levels)
    release(coded.sparkSession)
    straight = coded.where("long IS NULL AND x <> p").select(F.least("x", "p").alias("a"), F.greatest("x", "p").alias("b"))
    lo = _unpack(coded, "short").withColumnsRenamed({"x": "y", "root": "root_y", "n": "ny", "k": "ky", "rest": "ry", "far": "far_y"})
    hi = _unpack(coded, "long").drop("far")
    apart = F.expr("x <> y AND root <> root_y AND NOT (far_y AND x > y)")
    near = F.expr(f"100 * least(n, ny) >= {percent} * greatest(n, ny) AND {100 + percent} * abs(k - ky) <= {100 - percent} * (n + ny)")
    enough = F.expr(f"2 * {100 + percent} * least(rest, ry) >= {100 + percent} * (k + ky) - {100 - percent} * (n + ny)")
    met = hi.join(lo, ["p", "e"]).where(apart & near & enough)
    a_first = F.col("x") < F.col("y")
    pair = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(a_first, F.col("n")).otherwise(F.col("ny")).alias("na"), F.when(a_first, F.col("ny")).otherwise(F.col("n")).alias("nb")]
    return straight, met.select(*pair).distinct()


def ngram_jaccard(docs: DataFrame, n: int = 5, percent: int = 75, direct: int = 48, tiny: int = 4, few: int = 1 << 20) -> DataFrame:
    """documents -> doc_id, n_shingles, component_id: links are pairs with 100 * intersection >= percent * union.

    Groups of up to `tiny` rows give their pairs at once. direct is the size up to which a group's pairs across components are listed, so a class has at most that many partners
    in a group; larger groups go by their differences. It is raised to the size of groups that the sketch may not tell from
    rare n-grams (it grows with the square root of the corpus): their classes share little, so their differences would be nearly all of their sets. few bounds the list of texts that is broadcast to pick out the sets to
    verify. Neither bounds the result.
    """
    spark = docs.sparkSession
    tune(spark)
    order: list = []

    def counted() -> DataFrame:
        sets, counts = _sets(docs, n)
        order[:] = _levels(counts)
        return sets

    sets = distilled(spark, counted, "classes")  # the sketch is not kept
    levels, direct = spark.sparkContext.broadcast(order[0]), max(direct, order[1])
    release(spark)
    # an n-gram that one class alone has is of no use; frequent ones are kept unseen
    same = Window.partitionBy("key", "salt")
    # led one column at a time: a struct would be made before the shuffle and go through it
    led = lambda c, k: F.lead(c, k).over(same.orderBy("class"))
    after = F.array(*(F.struct(F.col(f"class{k}").alias("class"), F.col(f"n{k}").alias("n")) for k in range(1, tiny)))
    kept = _prefixes(docs, n, percent, levels).withColumns({f"{c}{k}": led(c, k) for c in ("class", "n") for k in range(1, tiny)}).withColumn("lo", F.min("class").over(same)).withColumn("hi", F.max("class").over(same)).withColumn("m", F.count("*").over(same))
    is_tiny = F.expr(f"salt = 0 AND m <= {tiny}")
    kept = materialize(kept.where("salt <> 0 OR lo < hi").select("key", "class", "n", F.when(is_tiny, after).alias("next"), is_tiny.alias("tiny")), "kept")
    release(spark)
    # groups of up to `tiny` rows: their few pairs at once
    listed = kept.where("tiny").select(F.col("class").alias("a"), F.col("n").alias("na"), F.explode("next").alias("o")).where("o.class <> a")
    listed = materialize(listed.select("a", F.col("o.class").alias("b"), "na", F.col("o.n").alias("nb")).where(_fits(percent)).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c")), "listed")
    members = materialize(kept.where("NOT tiny").select("key", "class", "n").distinct(), "members")
    release(spark)
    sizes = materialize(sets.where("n > 0").groupBy("class").agg(F.min("n").alias("n"), F.min(F.struct("d", "h")).alias("at")), "sizes")
    # poles of a group: its most central class (whose prefix n-grams have the most classes; of edited copies that is the original), the least and the greatest
    shared = members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    take = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    release(spark)
    central = materialize(members.join(shared, "key").groupBy("class", "n").agg((F.sum("m") / take).alias("score")).select("class", "score"), "central")
    poles = F.struct(F.max(F.struct("score", F.col("class").alias("id")))["id"].alias("p"), F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("m"))
    ends = materialize(members.join(central, "class").groupBy("key").agg(poles.alias("poles")).select("key", "poles.*").where("lo < hi"), "ends")
    met = members.join(ends, "key").select("class", "n", F.explode(F.array_distinct(F.array("p", "lo", "hi"))).alias("pole")).where("pole <> class").groupBy("class", "pole", "n").agg(F.count("*").alias("c"))
    # a pair of two poles is seen from both sides
    sized = met.join(sizes.select(F.col("class").alias("pole"), F.col("n").alias("np")), "pole")
    a_first = F.col("class") < F.col("pole")
    pair = [F.least("class", "pole").alias("a"), F.greatest("class", "pole").alias("b"), F.when(a_first, F.col("n")).otherwise(F.col("np")).alias("na"), F.when(a_first, F.col("np")).otherwise(F.col("n")).alias("nb")]
    first = materialize(_able(sized.select(*pair, "c").groupBy("a", "b", "na", "nb").agg(F.max("c").alias("c")).unionByName(listed).groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c")), percent), "pairs")
    release(spark)
    ends_of = lambda pairs: materialize(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "wanted")
    release(spark)
    links = distilled(spark, lambda: _count(first, _cut(_wholes(docs, n, ends_of(first), sizes, few), levels), percent, few), "links")
    roots = components(links)
    release(spark)
    # groups that lie in several components yet
    placed = materialize(members.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").select("key", "class", "n", F.coalesce("root", "class").alias("root")), "placed")
    split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key").join(ends.select("key", "p", "m"), "key")
    open_ = materialize(placed.join(split, "key"), "open")
    release(spark)
    small = open_.where(F.col("m") <= direct)
    across = materialize(_across(small, listed, percent), "small")
    release(spark)
    # a pair that shares a small group and a large one is counted too low here, but the large one finds it
    large = materialize(open_.where(F.col("m") > direct).select(F.col("class").alias("x"), "p", "root").distinct(), "large")
    ends_of_large = materialize(large.select(F.explode(F.array("x", "p")).alias("class")).distinct(), "wanted")
    straight, more = _by_differences(large, _wholes(docs, n, ends_of_large, sizes, few), percent, levels)
    across = materialize(across.unionByName(more).distinct().join(first, ["a", "b"], "left_anti"), "across")
    release(spark)
    found = distilled(spark, lambda: _count(across, _cut(_wholes(docs, n, ends_of(across), sizes, few), levels), percent, few), "found")
    roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(straight).unionByName(found))
    release(spark)
    labelled = sets.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("root", "class")).alias("root"))
    least = materialize(labelled.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    levels.unpersist()
    return labelled.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
