"""Prefix trie of conversations as a z-fast trie: compacted nodes in a hash table, found by fat binary search.

A sequence of turns is known by the 128-bit hashes of its prefixes. A compacted node stands for the edge (lo, hi] above it and
is filed under the hash of its path at the two-fattest depth of that interval (the one with most trailing zeros), so the node
where a conversation leaves the trie is found with as many look-ups, each an equi-join, as its length has binary digits.
Distinct conversations go in by batches that grow: locate, cut the edges where they leave inside one, add the new edges.
Sums over subtrees take doubling jumps over the compacted nodes; at the end edges are expanded to one row per depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy, tune

#: Batches of distinct conversations, as shares in 21sts: each is four times the one before.
SHARES = (1, 5, 21)
#: Bytes of one piece of a node's list of ids; pieces are hashed one after the other.
PIECE_BYTES = 1 << 16
_ROOT = "named_struct('a', 0L, 'b', 0L)"


def two_fattest(low: str, high: str) -> str:
    """SQL: the number in (low, high] that a power of two divides most often; low < high."""
    return f"(shiftleft(-1L, length(bin({low} ^ {high})) - 1) & {high})"


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), x, y (hashes of role and text), bytes; null role or text is empty, rows without conv_id are in no conversation.

    Order: turn, null first, then role, then the text's hashes, so equal rows of a turn give one result whatever their order.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    coded = rows.selectExpr("conv_id", "turn", "role", "xxhash64(11L, role, text) AS x", "xxhash64(13L, text, role) AS y", "CAST(octet_length(text) AS LONG) AS bytes")
    return coded.selectExpr("conv_id", "row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, x, y) AS pos", "x", "y", "bytes")


def shared_openings(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % group in place of its own first h; h = crc32(c) % most.

    Turns as `turns_in_order` gives them -> conv_id, part, pos, x, y, bytes. Conversations may end up without rows.
    """
    chosen = turns.where("pos = 1").selectExpr("conv_id", f"conv_id - conv_id % {group} AS base", f"crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {most} AS h")
    opening = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(chosen, "base").where("pos <= h")
    own = turns.where(F.col("pos") > F.expr(f"crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {most}"))
    return opening.selectExpr("conv_id", "0 AS part", "pos", "x", "y", "bytes").unionByName(own.selectExpr("conv_id", "1 AS part", "pos", "x", "y", "bytes"))


def paths(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """conv_id, n, end, path (hash of each prefix), cum (bytes up to each depth): one row per id; no rows, an empty path.

    Prefix hashes are running exclusive ors of hashes of (turn, depth), in a window that streams through a conversation.
    """
    deep = rows.selectExpr("conv_id", "row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d", "x", "y", "bytes")
    run = "OVER (PARTITION BY conv_id ORDER BY d)"
    hashed = deep.selectExpr("conv_id", "d", f"bit_xor(xxhash64(17L, x, y, d)) {run} AS a", f"bit_xor(xxhash64(19L, y, d, x)) {run} AS b", f"sum(bytes) {run} AS cum")
    whole = hashed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("d", "a", "b", "cum"))).alias("s"))
    whole = whole.selectExpr("conv_id", "transform(s, e -> named_struct('a', e.a, 'b', e.b)) AS path", "transform(s, e -> e.cum) AS cum")
    blank = ids.selectExpr("conv_id", "CAST(array() AS array<struct<a:bigint,b:bigint>>) AS path", "CAST(array() AS array<bigint>) AS cum").join(whole.select("conv_id"), "conv_id", "left_anti")
    return whole.unionByName(blank).selectExpr("conv_id", "size(path) AS n", f"coalesce(try_element_at(path, -1), {_ROOT}) AS end", "path", "cum")


def _edge(nodes: DataFrame) -> DataFrame:
    """Edges (lo, hi, label, cum with the entry of lo in front) with the hashes they are filed under: id, first and handle."""
    fat = two_fattest("CAST(lo AS BIGINT)", "CAST(hi AS BIGINT)")
    return nodes.selectExpr("parent", "lo", "hi", "label", "cum", "element_at(label, -1) AS id", "label[0] AS first", f"element_at(label, CAST({fat} - lo AS INT)) AS handle")


def _locate(batch: DataFrame, trie: DataFrame, rounds: int) -> DataFrame:
    """batch (end, n, path) -> with a, the depth of its deepest node in the trie, by fat binary search over (a, b].

    A handle that is met with its whole node moves a to the node, one that is met alone ends the search above that node, and
    one that is missed moves b below it. Every row probes with a hash of its own, also when it is done, so no null key piles up.
    """
    table = trie.select(F.col("handle").alias("probe"), F.col("id").alias("node"), F.col("lo").alias("node_lo"), F.col("hi").alias("node_hi"))
    now = batch.selectExpr("end", "n", "path", "0L AS a", "CAST(n AS BIGINT) AS b")
    for _ in range(rounds):
        fat = now.selectExpr("*", f"CASE WHEN a < b THEN {two_fattest('a', 'b')} END AS f")
        probed = fat.selectExpr("*", "CASE WHEN f IS NULL THEN end ELSE try_element_at(path, CAST(f AS INT)) END AS probe").join(table, "probe", "left")
        hit, whole = "f IS NOT NULL AND node IS NOT NULL", "coalesce(try_element_at(path, node_hi) = node, false)"
        now = probed.selectExpr(
            "end", "n", "path",
            f"CAST(CASE WHEN {hit} THEN CASE WHEN {whole} THEN node_hi ELSE node_lo END ELSE a END AS BIGINT) AS a",
            f"CAST(CASE WHEN {hit} THEN CASE WHEN {whole} THEN b ELSE node_lo END WHEN f IS NULL THEN b ELSE f - 1 END AS BIGINT) AS b",
        )
    return now


def _exits(located: DataFrame, trie: DataFrame) -> DataFrame:
    """end, m (depth up to which the trie holds the path), cut (the edge's id where m lies inside an edge, else null)."""
    child = trie.selectExpr("first AS step", "id AS edge", "label", "lo")
    met = located.selectExpr("end", "a", "n", "slice(path, CAST(a + 1 AS INT), 1073741824) AS rest", "CASE WHEN a < n THEN try_element_at(path, CAST(a + 1 AS INT)) ELSE end END AS step").join(child, "step", "left")
    inside = "edge IS NOT NULL AND a < n"
    shared = "size(filter(arrays_zip(rest, label), e -> e.rest = e.label))"
    return met.selectExpr("end", f"CAST(CASE WHEN {inside} THEN a + {shared} ELSE a END AS INT) AS m", f"CASE WHEN {inside} THEN edge END AS cut")


def _cut(trie: DataFrame, exits: DataFrame) -> DataFrame:
    """The trie with its edges divided at the depths where conversations of the batch leave them."""
    at = exits.where("cut IS NOT NULL").groupBy(F.col("cut").alias("id")).agg(F.sort_array(F.collect_set("m")).alias("cuts"))
    pieces = trie.join(at, "id", "left").selectExpr("parent", "lo", "hi", "label", "cum", "array_distinct(concat(array(lo), coalesce(cuts, CAST(array() AS array<int>)), array(hi))) AS ends")
    each = pieces.selectExpr("*", "explode(sequence(1, size(ends) - 1)) AS k").selectExpr("parent AS top", "lo AS low", "label AS whole", "cum AS sums", "ends[k - 1] AS lo", "ends[k] AS hi")
    return _edge(each.selectExpr("CASE WHEN lo = low THEN top ELSE whole[lo - low - 1] END AS parent", "lo", "hi", "slice(whole, lo - low + 1, hi - lo) AS label", "slice(sums, lo - low + 1, hi - lo + 1) AS cum"))


def _grown(batch: DataFrame, exits: DataFrame) -> DataFrame:
    """New edges of a batch: below each exit, between the depths where its conversations end or part.

    Each new prefix keeps its least conversation; of one conversation, the prefixes that kept it are the lowest part of its
    path, so its row alone gives their edges.
    """
    fresh = batch.join(exits, "end").where("m < n")
    steps = fresh.selectExpr("end", "path", "n", "explode(sequence(m + 1, n)) AS d").selectExpr("end AS seq", "d", "path[d - 1] AS key", "get(path, d) AS next", "d = n AS ends")
    keys = steps.groupBy("key").agg(F.min("seq").alias("end"), F.min("d").alias("d"), F.min("next").alias("p"), F.max("next").alias("q"), F.max("ends").alias("ends"))
    own = keys.groupBy("end").agg(F.min("d").alias("top"), F.sort_array(F.collect_list(F.expr("CASE WHEN ends OR p <> q THEN d END"))).alias("stops"))
    cut = own.selectExpr("end", "concat(array(top - 1), stops) AS stops").join(batch, "end").selectExpr("path", "cum", "stops", "explode(sequence(1, size(stops) - 1)) AS k").selectExpr("path", "cum", "stops[k - 1] AS lo", "stops[k] AS hi")
    return _edge(cut.selectExpr(f"CASE WHEN lo = 0 THEN {_ROOT} ELSE path[lo - 1] END AS parent", "lo", "hi", "slice(path, lo + 1, hi - lo) AS label", "concat(array(CASE WHEN lo = 0 THEN 0L ELSE cum[lo - 1] END), slice(cum, lo + 1, hi - lo)) AS cum"))


def build(sequences: DataFrame) -> DataFrame:
    """Distinct sequences (end, n, path, cum) -> the compacted nodes below the root: parent, lo, hi, label, cum, id, first, handle."""
    longest = sequences.agg(F.max("n")).first()[0] or 0
    trie = None
    for k, share in enumerate(SHARES):
        before = SHARES[k - 1] if k else 0
        batch = sequences.where(F.expr(f"n > 0 AND pmod(end.a, 21) >= {before} AND pmod(end.a, 21) < {share}"))
        if trie is None:
            trie = materialize(_grown(batch, batch.selectExpr("end", "0 AS m")), "trie")
            continue
        exits = materialize(_exits(_locate(batch, trie, longest.bit_length()), trie), "exits")
        trie = materialize(_cut(trie, exits).unionByName(_grown(batch, exits.select("end", "m"))), "trie")
    return trie


def _summed(nodes: DataFrame) -> DataFrame:
    """nodes (id, parent or null, w, least, leaves, weighted, edge) -> the same sums over each node's subtree.

    After round k a node has the sums of the descendants fewer than 2^k compacted nodes below it, and jumps 2^k up.
    """
    sums = ["w", "leaves", "weighted", "edge"]
    now = materialize(nodes.withColumnRenamed("parent", "jump"), "sums")
    while not now.where("jump IS NOT NULL").isEmpty():
        come = now.where("jump IS NOT NULL").groupBy(F.col("jump").alias("id")).agg(*(F.sum(c).alias(f"{c}2") for c in sums), F.min("least").alias("least2"))
        added = now.join(come, "id", "left").select("id", "jump", *((F.col(c) + F.coalesce(F.col(f"{c}2"), F.lit(0))).alias(c) for c in sums), F.least("least", "least2").alias("least"))
        added = materialize(added, "sums")
        # leaps from a written table, so that many nodes below one can be split over tasks
        up = added.where("jump IS NOT NULL").select(F.col("id").alias("jump"), F.col("jump").alias("leap"))
        now = materialize(added.join(up, "jump", "left").select("id", F.col("leap").alias("jump"), *sums, "least"), "sums")
    return now.drop("jump")


def end_digests(members: DataFrame) -> DataFrame:
    """members (end, conv_id) -> end, ends_sha256 of the ids in ascending order, comma-joined.

    Ids are sorted by ranges and joined to pieces of bounded size where they lie; a node's pieces alone meet in one task,
    which hashes them one after the other.
    """
    flat = members.select(F.col("end.a").alias("a"), F.col("end.b").alias("b"), "conv_id")

    @tidy
    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(key, ids):
            return pa.RecordBatch.from_pydict({"a": [key[0]], "b": [key[1]], "start": [ids[0]], "ids": [",".join(map(str, ids))]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int64()), ("ids", pa.string())]))

        key, ids = None, []
        for batch in batches:
            for a, b, i in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and ((a, b) != key or len(ids) * 20 > PIECE_BYTES):
                    yield piece(key, ids)
                    ids = []
                key = (a, b)
                ids.append(i)
        if ids:
            yield piece(key, ids)

    @tidy
    def hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
        key = sha = None
        found: list[tuple] = []
        for batch in batches:
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) != key:
                    if key is not None:
                        found.append((*key, sha.hexdigest()))
                    key, sha = (a, b), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                found = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*key, sha.hexdigest()), schema)], schema=schema)

    pieces = flat.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(join_ids, "a long, b long, start long, ids string")
    hashed = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "start").mapInArrow(hash_pieces, "a long, b long, ends_sha256 string")
    return hashed.select(F.struct("a", "b").alias("end"), "ends_sha256")


def _null_key() -> Column:
    return F.lit(None).cast("struct<a:bigint,b:bigint>")


def prefix_trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows (conv_id, part, pos, x, y, bytes) in the order (part, pos), and the ids of all conversations -> one row per node of their trie.

    conv_id (least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens (bytes that
    members share, over the subtree) and ends_sha256. Copies are one sequence with a count; conversations without rows end at
    the root; no ids, no nodes. A conversation's path of hashes is one value (24 bytes a turn), its texts are never gathered.
    """
    tune(rows.sparkSession)
    every = materialize(paths(rows, ids), "paths")
    sequences = materialize(every.groupBy("end").agg(F.first("n").alias("n"), F.first("path").alias("path"), F.first("cum").alias("cum"), F.count("*").alias("w"), F.min("conv_id").alias("least")), "sequences")
    trie = build(sequences.select("end", "n", "path", "cum"))
    root = rows.sparkSession.range(1).select(_null_key().alias("parent"), F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.expr("CAST(array() AS array<struct<a:bigint,b:bigint>>)").alias("label"), F.expr("array(0L)").alias("cum"), F.expr(_ROOT).alias("id"))
    nodes = trie.drop("first", "handle").unionByName(root)
    children = trie.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    weights = sequences.selectExpr("end AS id", "w", "least", "w * coalesce(try_element_at(cum, -1), 0L) AS weighted")
    known = materialize(nodes.join(weights, "id", "left").join(children, "id", "left"), "nodes")
    own = known.selectExpr("id", "parent", "coalesce(w, 0L) AS w", "least", "CASE WHEN n_children IS NULL THEN 1L ELSE 0L END AS leaves", "coalesce(weighted, 0L) AS weighted", "element_at(cum, -1) - cum[0] AS edge")
    total = _summed(own)
    ends = end_digests(every.select("end", "conv_id")).withColumnRenamed("end", "id")
    full = materialize(known.select("id", "parent", "lo", "hi", "cum", "n_children").join(total, "id").join(ends, "id", "left"), "full")
    above = full.select(F.col("id").alias("parent"), F.col("least").alias("above"))
    deep = full.join(above, "parent", "left").where("w > 0").selectExpr("*", "explode(sequence(least(lo + 1, hi), hi)) AS depth")
    before = "CASE WHEN depth = 0 THEN 0L ELSE cum[depth - 1 - lo] END"
    return deep.selectExpr(
        "least AS conv_id",
        "CAST(depth AS BIGINT) AS depth",
        "CASE WHEN depth > lo + 1 THEN least ELSE above END AS parent_conv_id",
        "w AS n_convs",
        "CASE WHEN depth < hi THEN 1L ELSE coalesce(n_children, 0L) END AS n_children",
        "leaves AS n_leaves",
        # all bytes of members below, less those above this node and one copy of each node of the subtree; edge holds the subtree's
        f"weighted - w * ({before}) - (edge - (({before}) - cum[0])) AS saved_tokens",
        "CASE WHEN depth = hi AND ends_sha256 IS NOT NULL THEN ends_sha256 ELSE sha2(CAST('' AS BINARY), 256) END AS ends_sha256",
    )
