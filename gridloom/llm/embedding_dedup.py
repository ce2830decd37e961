"""Near-duplicate vectors by sorted projection passes.

A pass gives every vector a key of concatenated sign bits of random projections, taken around the mean of its label, and
sorts vectors lexicographically by (label, length, key); each is compared with the `window` vectors that follow it. Near
vectors agree in most bits, so they meet in some pass. All pairs at or above the threshold (cosine in double precision) are
united across passes.

A first number of passes follows from the row count, as if strangers were spread evenly. Then the recall is measured: a
query set spread over all labels is compared with all vectors of its labels, and passes are added until the recall that is
asked for is reached. There is no upper limit: vectors that crowd together need more passes than spread ones.

Links within a component are then counted without listing them: the angle to the component's mean direction is a metric, so
vectors within half the threshold angle of it are all linked with each other; the few that are farther out are compared
with the component in blocks.

Results for odd inputs: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
label, link with nothing; vectors of different lengths never link; rows with equal ids count each; a null id stays null, is
never a component's id while a member has one, and is kept only if it stands alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, release, tune
from .components import components

#: Passes that are sorted at once: bounds the shuffled bytes, not the passes.
AT_ONCE = 16


def passes_for(rows: int, window: int, threshold: float, recall: float) -> int:
    """Passes after which a pair at the threshold has met with probability `recall` if strangers are spread evenly: it meets in one if the bits agree that tell `rows` vectors apart up to a window."""
    bits = max(1.0, math.log2(max(2.0, rows / window)))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _usable(rows: DataFrame) -> DataFrame:
    """uid, vec_id, label, dim, vec (float64 bytes; null if the vector can't link)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, dims = [], []
            for label, values in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                v = None if label is None or not values or any(x is None for x in values) else np.array(values, np.float64)
                top = 0.0 if v is None else np.abs(v).max()
                if v is None or not np.isfinite(top) or top == 0:
                    vecs.append(None)
                else:
                    v = v / top
                    vecs.append((v / np.sqrt(v @ v)).tobytes())
                dims.append(0 if v is None else len(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], names=["uid", "vec_id", "label", "dim", "vec"])

    rows = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return materialize(rows.mapInArrow(run, "uid long, vec_id long, label string, dim int, vec binary"), "vectors")


def _vector_sums(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The first `keys` columns and vec -> a row per task and key: the key columns, sum, n."""
    total: dict[tuple, list] = {}

    def flush(schema: pa.Schema) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in total], schema.field(i).type) for i in range(keys)]
        out = pa.RecordBatch.from_arrays([*columns, pa.array([v.tobytes() for v, _ in total.values()], pa.binary()), pa.array([n for _, n in total.values()], pa.int64())], names=[*schema.names[:keys], "sum", "n"])
        total.clear()
        return out

    for batch in batches:
        for *key, vec in zip(*(batch.column(i).to_pylist() for i in range(keys + 1))):
            v = np.frombuffer(vec, np.float64)
            held = total.get(tuple(key))
            if held:
                held[0] += v
                held[1] += 1
            else:
                total[tuple(key)] = [v.copy(), 1]
        if len(total) > 20_000:
            yield flush(batch.schema)
    if total:
        yield flush(batch.schema)


def _with_centres(vectors: DataFrame) -> DataFrame:
    """uid, label, dim, vec, mean: each vector with the mean of its label and length."""

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.sum([np.frombuffer(x, np.float64) for x in pdf["sum"]], axis=0) / int(pdf["n"].sum())
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "dim": pdf["dim"].iloc[:1], "mean": [v.tobytes()]})

    sums = vectors.select("label", "dim", "vec").mapInArrow(lambda b: _vector_sums(b, 2), "label string, dim int, sum binary, n long")
    means = materialize(sums.groupBy("label", "dim").applyInPandas(mean, "label string, dim int, mean binary"), "centres")
    return vectors.select("uid", "label", "dim", "vec").join(means, ["label", "dim"]).select("uid", "label", "dim", "vec", "mean")


def _keys(vectors: DataFrame, passes: range, seed: int) -> DataFrame:
    """A row per vector and pass: pass, label, dim, key (63 sign bits), uid, vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = (np.int64(1) << np.arange(62, -1, -1)).astype(np.int64)
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.concatenate([np.random.default_rng([seed, dim, p]).standard_normal((dim, 63)) for p in passes], 1)
                x, mean = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.float64).reshape(-1, dim) for i in (3, 4))
                keys = (((x - mean) @ planes[dim]) > 0).reshape(len(x), len(passes), 63) @ weights
                for i, p in enumerate(passes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), part.column(1), part.column(2), pa.array(keys[:, i]), part.column(0), part.column(3)], names=["pass", "label", "dim", "key", "uid", "vec"])

    return vectors.mapInArrow(run, "pass int, label string, dim int, key long, uid long, vec binary")


def _queries(vectors: DataFrame, queries: int) -> list:
    """About so many vectors (uid, label, dim, vec), as evenly over labels and lengths as there are any."""
    order = Window.partitionBy("label", "dim", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(4))).orderBy(F.xxhash64("uid"), "uid")
    ranked = vectors.select("uid", "label", "dim", "vec").withColumn("k", F.row_number().over(order)).where(F.col("k") <= min(1000, queries))
    return ranked.orderBy("k", F.xxhash64("uid"), "uid").limit(queries).select("uid", "label", "dim", "vec").collect()


def _recall(vectors: DataFrame, roots: DataFrame, queries: list, window: int, threshold: float) -> float:
    """The least share of true links of the queries that lie within a component: by label, and of queries with few and with many links.

    Groups in which the sample holds fewer than 50 links count in the totals only.
    """
    groups: dict[tuple, list[int]] = {}
    for i, q in enumerate(queries):
        groups.setdefault((q.label, q.dim), []).append(i)
    held = vectors.sparkSession.sparkContext.broadcast({k: (np.array(at), np.array([queries[i].uid for i in at]), np.stack([np.frombuffer(queries[i].vec, np.float64) for i in at])) for k, at in groups.items()})
    rooted = vectors.select("uid", "label", "dim", "vec").join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left").select("uid", "label", "dim", "vec", F.coalesce("root", "uid").alias("root"))
    places = {q.uid: i for i, q in enumerate(queries)}
    own = np.array([q.uid for q in queries], np.int64)
    spark = vectors.sparkSession
    for uid, root in roots.join(F.broadcast(spark.createDataFrame([(q.uid,) for q in queries], "node long")), "node").select("node", "root").collect():
        own[places[uid]] = root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, met = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for batch in batches:
            uid, root, vecs = batch.column(0).to_numpy(), batch.column(4).to_numpy(), batch.column(3).to_pylist()
            rows: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                rows.setdefault(key, []).append(i)
            for key, at in rows.items():
                if key not in held.value:
                    continue
                q, q_uid, x = held.value[key]
                y = np.stack([np.frombuffer(vecs[i], np.float64) for i in at])
                # a hair above the threshold, so that a product rounded otherwise is not missed for ever
                near = (x @ y.T >= threshold + 1e-9) & (q_uid[:, None] != uid[at][None, :])
                n[q] += near.sum(1)
                met[q] += (near & (own[q][:, None] == root[at][None, :])).sum(1)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(met[some])], names=["q", "n", "met"])

    counts = rooted.mapInArrow(run, "q long, n long, met long").groupBy("q").agg(F.sum("n").alias("n"), F.sum("met").alias("met")).collect()
    held.unpersist()
    totals: dict[tuple, list[int]] = {}
    for r in counts:
        many = r.n > window
        for group in ((many,), (many, queries[r.q].label)):
            t = totals.setdefault(group, [0, 0])
            t[0] += r.n
            t[1] += r.met
    return min((met / n for group, (n, met) in totals.items() if len(group) == 1 or n >= 50), default=1.0)


def _neighbours(threshold: float, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            old = 0 if tail is None else tail.num_rows
            if tail is not None:
                table = pa.concat_tables([tail, table])
            uid, dim, p = (table.column(c).to_numpy() for c in ("uid", "dim", "pass"))
            label = table.column("label").combine_chunks().dictionary_encode()
            label = (label.chunk(0) if isinstance(label, pa.ChunkedArray) else label).indices.to_numpy()
            vecs = table.column("vec").to_pylist()
            a, b = [], []
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                x = np.stack([np.frombuffer(vecs[i], np.float64) for i in at])
                for k in range(1, min(window, len(at) - 1) + 1):
                    i, j = at[:-k], at[k:]
                    near = (np.einsum("ij,ij->i", x[:-k], x[k:]) >= threshold) & (label[i] == label[j]) & (p[i] == p[j]) & (j >= old)
                    a.append(np.minimum(uid[i[near]], uid[j[near]]))
                    b.append(np.maximum(uid[i[near]], uid[j[near]]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], names=["a", "b"])
            tail = table.slice(max(0, table.num_rows - window))

    return run


def _link_counts(vectors: DataFrame, roots: DataFrame, threshold: float, block: int = 512) -> DataFrame:
    """uid, n_links for every vector in a component: exact counts of the links within it."""
    spark = vectors.sparkSession
    member = materialize(vectors.select("uid", "vec").join(roots.select(F.col("node").alias("uid"), "root"), "uid"), "members")

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.sum([np.frombuffer(x, np.float64) for x in pdf["sum"]], axis=0)
        norm = np.sqrt(v @ v)
        return pd.DataFrame({"root": pdf["root"].iloc[:1], "mean": [(v / norm if norm > 0 else v).tobytes()], "size": [int(pdf["n"].sum())]})

    # a component's rows are summed within each task first, so what meets is a row per component and task
    means = materialize(member.select("root", "vec").mapInArrow(lambda b: _vector_sums(b, 1), "root long, sum binary, n long").groupBy("root").applyInPandas(mean, "root long, mean binary, size long"), "means")
    half = math.cos(math.acos(threshold) / 2) + 1e-9

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [bool(np.frombuffer(v, np.float64) @ np.frombuffer(m, np.float64) >= half) for v, m in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(near)], names=["root", "uid", "size", "core"])

    judged = materialize(member.join(means, "root").select("root", "uid", "vec", "mean", "size").mapInArrow(judge, "root long, uid long, size long, core boolean"), "judged")
    outside = judged.where("NOT core")
    cores = materialize(judged.groupBy("root").agg(F.count_if("core").alias("n_core")), "cores")
    base = judged.join(cores, "root").select("uid", F.when(F.col("core"), F.col("n_core") - 1).otherwise(0).alias("n"))
    if outside.isEmpty():
        return base.select("uid", F.col("n").alias("n_links"))
    # those outside the core against all of their component, block by block; pairs of two outsiders are seen from both sides
    open_roots = materialize(outside.select("root").distinct(), "open")
    split = lambda df: df.withColumn("blk", F.pmod(F.xxhash64("uid"), F.greatest(F.lit(1).cast("long"), F.col("size").cast("long") / block).cast("long")))
    with_vec = judged.join(open_roots, "root", "left_semi").join(member.select("uid", "vec"), "uid")
    blocks = split(with_vec).groupBy("root", "blk").agg(F.collect_list(F.struct("uid", "vec", "core")).alias("rows"))
    blocks = materialize(blocks, "blocks")
    left = blocks.select("root", F.filter("rows", lambda r: ~r["core"]).alias("out")).where(F.size("out") > 0)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, n = [], []
            for out, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = (np.stack([np.frombuffer(r["vec"], np.float64) for r in part]) for part in (out, rows))
                a, b = (np.array([r["uid"] for r in part]) for part in (out, rows))
                near = (x @ y.T >= threshold) & (a[:, None] != b[None, :])
                core = np.array([r["core"] for r in rows])
                uid += [*a.tolist(), *b[core].tolist()]
                n += [*near.sum(1).tolist(), *near[:, core].sum(0).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(n, pa.int64())], names=["uid", "n"])

    more = left.join(blocks.select("root", "rows"), "root").select("out", "rows").mapInArrow(compare, "uid long, n long")
    return base.unionByName(more).groupBy("uid").agg(F.sum("n").alias("n_links"))


def _components(usable: DataFrame, threshold: float, window: int, recall: float, seed: int, queries: int) -> DataFrame:
    """node, root of linked vectors: passes until the measured recall is reached."""
    spark = usable.sparkSession
    centred = _with_centres(usable)
    sample = _queries(usable, queries)
    done, wanted, roots = 0, passes_for(usable.count(), window, threshold, recall), None
    while True:
        found = [] if roots is None else [roots.select(F.col("root").alias("a"), F.col("node").alias("b"))]
        while done < wanted:
            passes = range(done, min(wanted, done + AT_ONCE))
            ordered = _keys(centred, passes, seed).repartitionByRange(partitions(spark), "pass", "label", "dim", "key", "uid").sortWithinPartitions("pass", "label", "dim", "key", "uid")
            found.append(materialize(ordered.mapInArrow(_neighbours(threshold, window), "a long, b long").distinct(), "links"))
            release(spark)
            done = passes.stop
        roots = components(reduce(DataFrame.unionByName, found))
        reached = _recall(usable, roots, sample, window, threshold)
        if reached >= recall:
            return roots
        # what is missed shrinks by the same factor with each further pass, for pairs that are alike
        wanted = done + max(4, math.ceil(done * min(3.0, math.log(1 - recall) / math.log(1 - reached) - 1 if reached > 0 else 3.0)))


def near_vectors(rows: DataFrame, threshold: float = 0.93, window: int = 24, recall: float = 0.98, seed: int = 5, queries: int = 4000) -> DataFrame:
    """rows (vec_id, label, embedding) -> vec_id, n_links, component_id, kept."""
    tune(rows.sparkSession)
    base = _usable(rows)
    usable = base.where("vec IS NOT NULL")
    roots = _components(usable, threshold, window, recall, seed, queries)
    counts = materialize(_link_counts(usable, roots, threshold), "counts")
    ids = materialize(base.select("uid", "vec_id").join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left").select("uid", "vec_id", F.coalesce("root", "uid").alias("root")), "ids")
    least = materialize(ids.groupBy("root").agg(F.min("vec_id").alias("component_id")), "least")
    out = ids.join(least, "root").join(counts, "uid", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
