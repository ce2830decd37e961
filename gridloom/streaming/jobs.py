"""Streams of job events: rates, budgets, current state, sessions, leases and freshness.

Each function takes a streaming (or batch) DataFrame of job events and returns one; drain() runs a stream to the end of
what there is and gives the result as a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gridloom.sources.shared import scratch

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


#: How far rows may come out of order of event time, in the dealt files and in the jobs' watermarks.
LATE = "6 hours"


def read_events(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """The Parquet files of a folder or pattern as a stream, so many files to a micro-batch, oldest first."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


#: Rows of a file that deal() aims at; files of fewer rows are only written where a part has no more.
PIECE = 250_000


def deal(events: DataFrame, path: str, files: int = 4, late_s: int = 6 * 3600, piece: int | None = None) -> tuple[str, int]:
    """Events as parts that arrive one after the other, each row up to late_s out of order: the table as a log of arrivals.

    Parts hold about equally many rows. With `piece`, a part is several files of that many rows at least, else one. Returns the
    pattern of all files and how many make up a part, which is what a micro-batch should take.
    """
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    come = us + F.pmod(F.xxhash64("event_id"), F.lit(late_s * 1_000_000))
    cuts = events.agg(F.percentile_approx(come, [k / files for k in range(1, files)] or [1.0])).first()[0] or []
    part = reduce(add, [(come > c).cast("int") for c in cuts[: files - 1]], F.when(come.isNotNull(), 0))
    held = {r["part"]: r["n"] for r in events.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect() if r["part"] is not None}
    pieces = max(1, min(held.values(), default=0) // piece) if piece else 1
    for k in sorted(held) or [0]:
        events.where(part == k).repartition(pieces).write.mode("append").parquet(f"{path}/{k:04d}")
    return f"{path}/*", pieces


def deal_files(events: DataFrame, path: str, files: int = 4, late_s: int = 6 * 3600) -> str:
    """The pattern of deal() with one file a part."""
    return deal(events, path, files, late_s)[0]


def drain(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run until all available input is read. append: all rows; update: of each key the rows of its last batch, and of rows
    with a column `settled` all settled ones. Batches are written under their number, so a repeated batch replaces itself."""
    spark = stream.sparkSession
    path = scratch(spark, "stream")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    rows = spark.read.schema(f"{', '.join(f'`{n}` {t}' for n, t in stream.dtypes)}, batch long").parquet(path)
    if mode == "update":
        newest = rows.groupBy(*keys).agg(F.max("batch").alias("newest"))
        met = rows.join(newest.select(*(F.col(k).alias(f"_{k}") for k in keys), "newest"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        rows = met.where((F.col("batch") == F.col("newest")) | (F.col("settled") if "settled" in stream.columns else F.lit(False))).select(*rows.columns)
    return rows.drop("batch")


def publication_rate(events: DataFrame, width: str = "1 hour", slide: str = "30 minutes", late: str = LATE) -> DataFrame:
    """Completed tiles per sliding window, for update mode: windows behind the watermark leave the state, rows later than it are dropped."""
    w = F.window("ts", width, slide)
    done = events.where("state = 'complete'").withWatermark("ts", late).groupBy(w).agg(F.count("*").alias("n"))
    return done.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def commit_budget(events: DataFrame, budget: int, width: str = "1 hour", slide: str = "30 minutes") -> DataFrame:
    """Windows with more commits than the budget allows."""
    return publication_rate(events, width, slide).withColumn("over", F.col("n") > budget)


def current_state(events: DataFrame) -> DataFrame:
    """The latest state of each tile and stage, for update mode. A maximum needs neither order nor deduplication; the state has a row per tile and stage."""
    best = events.groupBy("tile", "stage").agg(F.max(F.struct("ts", "event_id", "state")).alias("m"))
    return best.select("tile", "stage", F.col("m.state").alias("state"))


class InOrder(StatefulProcessor):
    """Rows of each key stepped in event time, whatever their order of arrival within the watermark's delay.

    Spark groups by a bucket of keys, as each call and each read of the state has a fixed cost; within a bucket keys are
    apart. Rows wait in the state until the watermark has passed their `at`; then they are stepped for good and leave it.
    Rows that still wait are stepped on a copy, so each batch also gives the outcome so far, not settled. Of each key with
    rows a call gives one row with null outcome columns, which replaces what the key showed before. `fold` has start,
    step(carry, row) -> (carry, outcomes) and open(carry) -> outcomes; a carry is a tuple of longs and nulls. Longs come
    without nulls, the last column has a bit for each that was null.
    """

    def __init__(self, fold, keys: pa.Schema, columns: list[str], carry: list[str]):
        self.fold, self.n = fold, len(keys)
        self.rows = pa.schema([*keys, *(pa.field(c, pa.int64()) for c in columns), pa.field("nulls", pa.int64())])
        self.carried = pa.schema([*keys, pa.field("nulls", pa.int64()), *(pa.field(f"carry_{c}", pa.int64()) for c in carry)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "rows binary")
        self.carry = handle.getValueState("carry", "rows binary")

    @staticmethod
    def _load(state, schema: pa.Schema) -> pa.Table:
        if not state.exists():
            return schema.empty_table()
        with pa.ipc.open_stream(bytes(state.get()[0])) as reader:
            return reader.read_all()

    @staticmethod
    def _save(state, table: pa.Table) -> None:
        if table.num_rows == 0:
            state.clear()
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))

    def _run(self, fresh: list[pa.Table], timers) -> pd.DataFrame:
        passed, names, n = timers.getCurrentWatermarkInMs() * 1000, self.rows.names, self.n
        table = pa.concat_tables([self._load(self.waiting, self.rows), *fresh])
        # keys with their null bits first, then `at`: a key's rows are together and in order
        key_bits = pc.bit_wise_and(table["nulls"], (1 << n) - 1)
        table = table.append_column("bits", key_bits).sort_by([(c, "ascending") for c in [*names[:n], "bits", *names[n:]]])
        carries = {tuple(r[: n + 1]): tuple(r[n + 1 :]) for r in zip(*(c.to_pylist() for c in self._load(self.carry, self.carried).columns))}
        nulls, fold = table["nulls"].to_pylist(), self.fold
        rows = list(zip(*(table[c].to_pylist() for c in names[n:-1])))
        for i, bits in enumerate(nulls):
            if bits >> n:
                rows[i] = tuple(None if bits >> n + j & 1 else v for j, v in enumerate(rows[i]))
        out: list[tuple] = []
        last = carry = key = None
        settled = True
        for ident, row in zip(zip(*(table[c].to_pylist() for c in [*names[:n], "bits"])), rows):
            if ident != last:
                if last is not None:
                    if settled:
                        carries[last] = carry
                    out += [(*key, False, *f) for f in fold.open(carry)]
                last, settled, carry = ident, True, carries.get(ident, fold.start)
                key = tuple(None if ident[n] >> j & 1 else v for j, v in enumerate(ident[:n]))
                out.append((*key, False, *(None,) * len(fold.outcome)))
            if settled and row[0] >= passed:
                carries[last], settled = carry, False
            carry, found = fold.step(carry, row)
            if found:
                out += [(*key, settled, *f) for f in found]
        if last is not None:
            if settled:
                carries[last] = carry
            out += [(*key, False, *f) for f in fold.open(carry)]
        wait = table.filter(pc.greater_equal(table[names[n]], passed)).select(names)
        self._save(self.waiting, wait)
        if wait.num_rows < table.num_rows:
            held = [(*k, *c) for k, c in carries.items() if c != fold.start]
            self._save(self.carry, pa.table([pa.array([r[i] for r in held], f.type) for i, f in enumerate(self.carried)], schema=self.carried))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if wait.num_rows:
            self.handle.registerTimer(pc.min(wait[names[n]]).as_py() // 1000 + 1)
        found = list(zip(*out)) if out else [[]] * (n + 1 + len(fold.outcome))
        kinds = {**{f.name: "Int64" for f in self.rows if pa.types.is_integer(f.type)}, **{c: "Int64" for c in fold.outcome if c not in fold.texts}}
        return pd.DataFrame({c: pd.array(v, kinds[c]) if c in kinds else pd.Series(v, dtype=bool if c == "settled" else object) for c, v in zip([*names[:n], "settled", *fold.outcome], found)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield self._run([pa.Table.from_pandas(part[self.rows.names], self.rows, preserve_index=False) for part in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._run([], timerValues)

    def close(self) -> None:
        pass


#: Buckets of keys in the state. A bucket's rows are in one task's memory: those of so many keys as fall to it, of one batch and of the watermark's delay.
BUCKETS = 1024


def _in_order(events: DataFrame, key: list[str], columns: list[str], fold, carry: list[str], late: str) -> DataFrame:
    """events with `at` (microseconds) first among the columns; result: key, settled and the fold's outcome, for update mode."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kinds = dict(events.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), "settled boolean", *(f"{c} {'string' if c in fold.texts else 'long'}" for c in fold.outcome)])
    types = to_arrow_schema(events.select(*key).schema)
    empty = {k: F.lit("") if kinds[k] == "string" else F.lit(0).cast(kinds[k]) for k in key}
    bits = [F.col(c).isNull().cast("long") * (1 << i) for i, c in enumerate([*key, *columns])]
    full = [F.coalesce(c, empty[c]).alias(c) for c in key] + [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in columns]
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).alias("bucket")
    # a row without a time has no place in the order
    timed = events.where(F.col(columns[0]).isNotNull()).withWatermark("ts", late).select(bucket, "ts", *full, reduce(add, bits).alias("nulls"))
    return timed.groupBy("bucket").transformWithStateInPandas(InOrder(fold, types, columns, carry), schema, "update", "EventTime")


def outcomes(drained: DataFrame, one: str) -> DataFrame:
    """What a stream in order came to: without the rows that only replaced earlier ones."""
    return drained.where(F.col(one).isNotNull()).drop("settled")


class _Leases:
    """Fencing: a running event claims a free or expired lease for its worker or renews its own; a complete event counts only for the owner before expiry."""

    key, outcome, texts, start = ["tile", "stage"], ["event_id", "outcome"], ["outcome"], (None, 0)

    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def step(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        (owner, expires), (us, event_id, worker, running) = carry, row
        held = owner is not None and us < expires
        if running and (not held or owner == worker):
            return (worker, us + self.ttl_us), [(event_id, "renewed" if held else "claimed")]
        if not running and held and owner == worker:
            return (None, 0), [(event_id, "completed")]
        return carry, [(event_id, "rejected")]

    def open(self, carry: tuple) -> list[tuple]:
        return []


def leases(events: DataFrame, ttl_s: int = 3600, late: str = LATE) -> DataFrame:
    """Fenced leases per tile and stage: tile, stage, settled, event_id, outcome (claimed, renewed, completed, rejected).

    Expiry is event time: late completions are rejected. Events of one microsecond go by event_id.
    """
    wanted = events.where("state IN ('running', 'complete')").withColumns({"at": F.unix_micros("ts"), "running": (F.col("state") == "running").cast("long")})
    return _in_order(wanted, ["tile", "stage"], ["at", "event_id", "worker", "running"], _Leases(ttl_s * 1_000_000), ["owner", "expires"], late)


class _Stalls:
    key, outcome, texts, start = ["worker"], ["from_us", "to_us"], [], (None,)

    def __init__(self, stall_us: int):
        self.stall_us = stall_us

    def step(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        last, us = carry[0], row[0]
        return (us,), [(last, us)] if last is not None and us - last > self.stall_us else []

    def open(self, carry: tuple) -> list[tuple]:
        return []


def stalls(events: DataFrame, stall_s: int = 7200, late: str = LATE) -> DataFrame:
    """worker, settled, from_us, to_us: times between a worker's completed tiles that are longer than a stall; kept for good is the last completion."""
    done = events.where("state = 'complete'").withColumn("at", F.unix_micros("ts"))
    return _in_order(done, ["worker"], ["at"], _Stalls(stall_s * 1_000_000), ["last"], late)


class _Sessions:
    key, outcome, texts, start = ["worker"], ["start_us", "n", "failed"], [], (None, 0, 0, 0)

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def step(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        (start, last, n, failed), (us, bad) = carry, row
        if start is None or us >= last + self.gap_us:
            return (us, us, 1, bad), self.open(carry)
        return (start, us, n + 1, failed + bad), []

    def open(self, carry: tuple) -> list[tuple]:
        return [] if carry[0] is None else [(carry[0], *carry[2:])]


def worker_sessions(events: DataFrame, gap_s: int = 7200, late: str = LATE) -> DataFrame:
    """Sessions of each worker with counts of outcomes: worker, settled, start_us, n, failed. The session that is open is never settled."""
    coded = events.withColumns({"at": F.unix_micros("ts"), "bad": (F.col("state") == "failed").cast("long")})
    return _in_order(coded, ["worker"], ["at", "bad"], _Sessions(gap_s * 1_000_000), ["start", "last", "n", "failed"], late)


class _Edits:
    """Layers in order; of a layer the edit of highest priority, then least seq, counts for a cell, and applies if the cell is as it expects."""

    outcome, texts, start = ["state", "applied", "rejected"], [], (None, -1, 0, 0)

    def __init__(self, key: list[str]):
        self.key = key

    def step(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        (state, layer, applied, rejected), (end, _, _, new, expect, empty) = carry, row
        if end == layer:
            return carry, []
        if (state is None) if empty else state == expect:
            return (new, end, applied + 1, rejected), []
        return (state, end, applied, rejected + 1), []

    def open(self, carry: tuple) -> list[tuple]:
        return [(carry[0], carry[2], carry[3])]


def apply_edit_stream(edits: DataFrame, keys: list[str], late: str = LATE) -> DataFrame:
    """Edits (ts, keys, layer_end timestamp, state, expect, priority, seq) -> keys, settled, state, applied, rejected: the world after all layers.

    The state store is the block table, one small carry per cell; a batch touches only its cells. A layer is applied for good
    when the watermark passes its end, so the order of arrival within the delay does not matter. expect null: an empty cell.
    """
    coded = edits.withColumns({"at": F.unix_micros("layer_end"), "rank": -F.col("priority"), "empty": F.col("expect").isNull().cast("long"), "wants": F.coalesce("expect", F.lit(0).cast("long"))})
    return _in_order(coded, keys, ["at", "rank", "seq", "state", "wants", "empty"], _Edits(keys), ["state", "layer", "applied", "rejected"], late)


def publish_once(stream: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Each key is published once, however often it arrives: a batch is joined against the ledger of earlier batches.

    A batch writes under its number, so a batch that is run again replaces what it wrote and never counts against itself.
    """
    spark = stream.sparkSession
    schema = ", ".join(f"`{n}` {t}" for n, t in stream.dtypes)

    def write(batch: DataFrame, number: int) -> None:
        batch.limit(0).write.mode("overwrite").parquet(f"{path}/batch={number}")
        ledger = spark.read.schema(f"{schema}, batch long").parquet(path).where(F.col("batch") < number).select(*keys)
        batch.dropDuplicates(keys).join(ledger, keys, "left_anti").write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.option("checkpointLocation", f"{path}-state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.schema(f"{schema}, batch long").parquet(path).drop("batch")
