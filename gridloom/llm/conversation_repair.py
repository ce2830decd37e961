"""Repair of conversations to (system?)(user assistant)+ at least cost, by the auction algorithm for shortest paths.

The lattice of a conversation has a node per row position and grammar state; its arcs are the edits with their integer costs.
The auction keeps a price per node, extends a path from the origin to the neighbour of least cost plus price, and raises the
price of the path's end and contracts where no arc is tight. When the path arrives, all shortest paths consist of tight arcs
(price = cost + next price), and the ASCII-least string of edits is traced along them. Rows are taken in blocks from the last
to the first, each against the converged prices after it, so work grows with the conversation's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidy, tune

#: Costs of the edits; a truncated row that stays costs `CUT` more.
RELABEL, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
SOUND, TRUNCATED, GOES = range(3)
WHITE = " \t\n\x0b\x0c\r"
_FAR = 1 << 60


def _keeps(state: int, initial: str) -> int:
    """The state after a row with this initial; -1 where the grammar has none. An empty role adds no initial."""
    if initial == "":
        return state
    if state == USER:
        return ASSISTANT if initial == "a" else -1
    return SYSTEM if initial == "s" and state == EMPTY else USER if initial == "u" else -1


def _turned(state: int) -> int:
    return ASSISTANT if state == USER else USER


def arcs(rows: list[tuple[str, int]], node: int) -> list[tuple[int, str, int]]:
    """(cost, edit, next node) of node 4 * position + state; the arcs of an end state to the goal have no edit."""
    at, state = divmod(node, 4)
    found = [(INSERT, "I", 4 * at + _turned(state))]
    if at == len(rows):
        if state in (EMPTY, ASSISTANT):
            found.append((0, "", 4 * (at + 1)))
        return found
    initial, fault = rows[at]
    found.append((DELETE, "D", node + 4))
    if fault != GOES:
        more = CUT if fault == TRUNCATED else 0
        after = _keeps(state, initial)
        if after >= 0:
            found.append((more, "K", 4 * (at + 1) + after))
        found.append((RELABEL + more, "R", 4 * (at + 1) + _turned(state)))
    return found


def auction(rows: list[tuple[str, int]], block: int = 16) -> tuple[list[int], list[list[tuple[int, str, int]]]]:
    """Prices of all nodes, and their arcs: exact for nodes that begin a block or lie on a shortest path, else a lower bound."""
    n = len(rows)
    out = [arcs(rows, k) for k in range(4 * (n + 1))]
    price = [0] * (4 * (n + 2))
    least = [(DELETE if f == GOES else CUT if f == TRUNCATED else 0) for _, f in rows] + [0]
    end = n + 1
    while end > 0:
        begin = max(0, end - block)
        bound = min(price[4 * end : 4 * end + 4]) if end <= n else 0
        for at in range(end - 1, begin - 1, -1):  # a first price that no arc undercuts
            bound += least[at]
            price[4 * at : 4 * at + 4] = [bound] * 4
        stop = 4 * end
        for origin in range(4 * begin, 4 * begin + (4 if begin else 1)):
            path = [origin]
            while path[-1] < stop:
                node = path[-1]
                best, to = _FAR, -1
                for cost, _, other in out[node]:
                    if cost + price[other] < best:
                        best, to = cost + price[other], other
                if price[node] < best:
                    price[node] = best
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(to)
        end = begin
    return price, out


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Least cost and the ASCII-least edits of that cost; rows are (initial, SOUND, TRUNCATED or GOES).

    A node has at most one arc per edit, so paths and strings of edits match one to one and the least is taken arc by arc,
    among tight arcs that reach the goal by tight arcs.
    """
    n = len(rows)
    price, out = auction(rows)
    goal = 4 * (n + 1)
    tight = [[(edit, to) for cost, edit, to in out[k] if price[k] == cost + price[to]] for k in range(goal)]
    leads = [False] * goal + [True] + [False] * 3
    for at in range(n, -1, -1):
        for _ in range(2):  # inserts stay at a position: from any state to user, from user to assistant
            for state in (ASSISTANT, USER, EMPTY, SYSTEM):
                leads[4 * at + state] = any(leads[to] for _, to in tight[4 * at + state])
    node, edits = 0, []
    while node < goal:
        edit, node = min((edit, to) for edit, to in tight[node] if leads[to])
        edits.append(edit)
    return price[0], "".join(edits)


class _Memo:
    """Answers for short row patterns, which repeat; bounded."""

    def __init__(self, entries: int = 100_000, longest: int = 32):
        self.known: dict[tuple, tuple[int, str]] = {}
        self.entries, self.longest = entries, longest

    def __call__(self, rows: list[tuple[str, int]]) -> tuple[int, str]:
        if len(rows) > self.longest:
            return cheapest(rows)
        key = tuple(rows)
        if key not in self.known:
            if len(self.known) >= self.entries:
                self.known.clear()
            self.known[key] = cheapest(rows)
        return self.known[key]


class _Conversation:
    """Faults and counts of one conversation, fed row by row in order."""

    def __init__(self, key):
        self.key, self.rows, self.seen = key, [], set()
        self.turns, self.low, self.high = 0, None, None
        self.counts = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.last_turn = self.last_initial = None

    def add(self, turn, initial: str, digest: bytes, blank: bool, cut: bool) -> None:
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            self.last_turn = self.high = turn
            self.low = turn if self.low is None else self.low
        fault = 0 if blank else 1 if digest in self.seen else 2 if cut else -1
        self.seen.add(digest)
        if fault >= 0:
            self.counts[fault] += 1
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.counts[3] += 1
        self.last_initial = initial
        self.rows.append((initial, GOES if fault in (0, 1) else TRUNCATED if fault == 2 else SOUND))

    def report(self, memo: _Memo) -> tuple:
        cost, audit = memo(self.rows) if self.rows else (0, "")
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.key, gaps, *self.counts, cost, audit)


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(rows: DataFrame) -> DataFrame:
    """conversations -> conv_id, turn, role, text, present: the planted faults, by crc32(`conv_id:turn`) % 20.

    Nulls of role, text and, within that key, conv_id and turn stand for one space. Rows that are dropped stay as rows whose
    `present` is false, so that their conversation is known.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("code") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def _in_order(rows: DataFrame, first: list[str]) -> DataFrame:
    """Conversations whole in one task, their rows by turn (null first), then role, then text digest."""
    order = [F.col(c) for c in ("conv_id", *first)] + [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def structure(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, present) -> conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    One row per conversation; rows that are not present only say that it exists. A null conv_id is a conversation of its own;
    null roles and texts stand for one space. Rows of one turn go by role and text digest, so repeated rows are neighbours.
    A task holds flags and digests of one conversation at a time, never its texts. Other columns are left out; no rows, no
    conversations.
    """
    tune(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    clean = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "present")
    end = F.rtrim("text", F.lit(WHITE))
    flags = clean.select("conv_id", "turn", "role", _digest().alias("digest"), (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"), "present")
    flags = flags.withColumn("role", F.when(F.col("present"), F.col("role")))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, now, found = _Memo(), None, []
        for batch in batches:
            for key, turn, role, digest, blank, cut, present in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.key != key:
                    if now is not None:
                        found.append(now.report(memo))
                    now = _Conversation(key)
                if present:
                    now.add(turn, role[:1], digest, blank, cut)
            if len(found) >= 2000:
                yield _table(found, schema)
                found = []
        if now is not None:
            found.append(now.report(memo))
        if found:
            yield _table(found, schema)

    schema = pa.schema([("conv_id", _arrow(kind)), *((c, pa.int64()) for c in REPORT), ("audit", pa.string())])
    return _in_order(flags, []).mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class _Writer:
    """Carries out a conversation's edits as its rows pass by: inserts stand before the edit of the next row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, EMPTY

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = _turned(self.state)
            yield "I", "user" if self.state == USER else "assistant", ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _keeps(self.state, role[:1])
            yield "K", role, text
        elif edit == "R":
            self.state = _turned(self.state)
            yield "R", "user" if self.state == USER else "assistant", text


def repair(rows: DataFrame, digest_only: bool = False) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit; with digest_only one row per conversation with
    the columns of `structure` and repaired_sha256, of `role:text` lines.

    Reports travel first to where their conversation's texts pass by in order, so a task holds one row's text at a time. Nulls,
    ties and copies: as `structure`. Conversations without rows have no repaired rows and the digest of the empty string.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    reports = structure(rows)
    texts = rows.where("present").select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    texts = texts.select("conv_id", F.lit(1).alias("part"), "turn", "role", _digest().alias("digest"), "text", F.lit(None).cast("array<bigint>").alias("counts"))
    heads = reports.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.array(*REPORT).alias("counts"))
    names = [("conv_id", _arrow(kind)), *((c, pa.int64()) for c in REPORT), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    if not digest_only:
        names = [("conv_id", _arrow(kind)), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
    schema = pa.schema(names)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        writer = head = sha = None
        position = 0

        def take(turns) -> None:
            nonlocal position
            for edit, role, text in turns:
                if digest_only:
                    sha.update((("\n" if position else "") + role + ":" + text).encode())
                else:
                    found.append((head[0], position, role, text, edit))
                position += 1

        def close() -> None:
            if writer is not None:
                take(writer.inserts())
                if digest_only:
                    found.append((head[0], *head[1], writer.audit, sha.hexdigest()))

        for batch in batches:
            for key, part, _, role, _, text, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part == 0:
                    close()
                    writer, head, sha, position = _Writer(text), (key, counts), hashlib.sha256(), 0
                else:
                    take(writer.row(role, text))
            if found:
                yield _table(found, schema)
                found = []
        close()
        if found:
            yield _table(found, schema)

    spark = {"bigint": "bigint", "int": "int", "string": "string"}
    ddl = ", ".join(f"{f.name} {kind if f.name == 'conv_id' else 'bigint' if f.type == pa.int64() else spark['string']}" for f in schema)
    return _in_order(heads.unionByName(texts), ["part"]).mapInArrow(run, ddl)
