"""Toxicity by a weighted finite-state grammar over clauses.

Transducers, composed into one table: the lexicon (a character trie from words to a class and a weight) reads letters and
writes word classes; negation, reported speech, target and threat machines read word classes and write a tag for every
insult or threat. A clause matches if the composition writes a tag; a document's score is a logistic function of its
matched clauses, whose arc weights (one per tag) are learned.

Learned from labels: the lexicon's insult stems (word beginnings that toxic documents have far more often) and the arc
weights. Negation, report, target and threat words are short fixed lists in four languages.

Results for odd inputs: null and empty texts match nothing and get the score of no match; documents with equal ids are
scored each; unlabelled rows (or null labels) teach nothing; without both labels among the training rows, nothing is toxic;
extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy, tune

# Function words by class, in English, German, French and Spanish.
TARGET = "you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus usted ustedes vosotros".split()
NEGATION = "not never without hardly nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco".split()
REPORT = "said says saying called calls quoted wrote claimed sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split()
THREAT = "kill hurt destroy punish beat stab shoot töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")
OTHER, INSULT, MENACE, AIMED, NEGATES, REPORTS = range(6)
TAGS = ["plain", "aimed", "negated", "reported", "menace", "menace_aimed"]
STEMS = range(3, 10)


@dataclass(frozen=True)
class Machine:
    """A deterministic transducer: (state, symbol) -> (state, output); what it has no arc for stays in place and passes through."""

    arcs: dict[tuple[int, object], tuple[int, object]] = field(default_factory=dict)

    def step(self, state: int, symbol: object) -> tuple[int, object]:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(machines: list[Machine], symbols: list[object]) -> dict[tuple[tuple[int, ...], object], tuple[tuple[int, ...], object]]:
    """The table of the machines run one after another, over all states that can be reached from the start."""
    table, todo = {}, [(0,) * len(machines)]
    while todo:
        state = todo.pop()
        for symbol in symbols:
            out, nxt = symbol, []
            for m, s in zip(machines, state):
                s, out = m.step(s, out)
                nxt.append(s)
            if (state, symbol) not in table:
                table[state, symbol] = (tuple(nxt), out)
                if not any((tuple(nxt), x) in table for x in symbols):
                    todo.append(tuple(nxt))
    return table


def grammar(scope: int = 3) -> dict:
    """Negation and reports act on the next `scope` words of a clause, a target on the whole rest of it."""
    def scoped(trigger: int, name: str) -> Machine:
        arcs: dict = {}
        for left in range(scope + 1):
            arcs[left, trigger] = (scope, trigger)
            if left:
                arcs[left, INSULT] = (left - 1, name)
                for s in (OTHER, AIMED, MENACE, NEGATES, REPORTS, "negated", "reported"):
                    if s != trigger and (left, s) not in arcs:
                        arcs[left, s] = (left - 1, s)
        return Machine(arcs)

    aim = Machine({(0, AIMED): (1, AIMED), (1, INSULT): (1, "aimed"), (0, INSULT): (0, "plain"), (0, MENACE): (0, "menace"), (1, MENACE): (1, "menace_aimed")})
    return compose([scoped(NEGATES, "negated"), scoped(REPORTS, "reported"), aim], list(range(6)))


_GRAMMAR = grammar()
_START = (0, 0, 0)


class Lexicon:
    """Word -> (class, weight): fixed words, and stems by the longest known beginning of a word ("=word": the whole word)."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.heads = {s.lstrip("=")[:3] for s in stems}
        self.fixed = {w: k for k, words in ((AIMED, TARGET), (NEGATES, NEGATION), (REPORTS, REPORT), (MENACE, THREAT)) for w in words}

    def weight(self, word: str) -> float:
        whole = self.stems.get("=" + word)
        if whole is not None:
            return whole
        return next((self.stems[word[:k]] for k in range(min(STEMS[-1], len(word)), STEMS[0] - 1, -1) if word[:k] in self.stems), 0.0)

    def matches(self, words: set[str]) -> set[str]:
        heads, fixed = self.heads, self.fixed
        return {w for w in words if (w[:3] in heads and self.weight(w) > 0) or fixed.get(w) == MENACE}

    def features(self, text: str | None) -> list[float]:
        """Summed weights by tag over the clauses that match, the best clause, matched clauses, and words."""
        low = (text or "").lower()
        words = WORD.findall(low)
        sums = dict.fromkeys(TAGS, 0.0)
        best, clauses = 0.0, 0
        hits = self.matches(set(words))
        if hits:
            for clause in CLAUSE.split(low):
                tokens = WORD.findall(clause)
                if hits.isdisjoint(tokens):
                    continue
                state, total = _START, 0.0
                for w in tokens:
                    value = self.weight(w) if w in hits else 0.0
                    symbol = self.fixed.get(w, INSULT if value > 0 else OTHER)
                    state, out = _GRAMMAR[state, symbol]
                    if isinstance(out, str):
                        sums[out] += value or 1.0
                        total += value or 1.0
                best, clauses = max(best, total), clauses + 1
        size = math.log1p(len(words))
        return [*(math.log1p(sums[t]) for t in TAGS), best, math.log1p(clauses), math.log1p(sum(sums.values())) - size / 4, 100 * sum(sums.values()) / (len(words) + 20)]


@dataclass
class ToxicityModel:
    stems: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    arcs: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(features)), (features - self.mean) / self.scale]) @ self.arcs
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _stem_counts(sample: DataFrame) -> DataFrame:
    """stem, n1, n0: documents of each label that have it, counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(counts[1].keys() | counts[0].keys())
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())], names=["stem", "n1", "n0"])
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall((text or "").lower()))
                counts[toxic].update({"=" + w for w in words} | {w[:k] for w in words for k in STEMS if len(w) > k})
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield flush()
        yield flush()

    return sample.mapInArrow(tidy(run), "stem string, n1 long, n0 long").groupBy("stem").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is not penalised."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(labelled: DataFrame, per_label: int = 6000, stems: int = 3000, least: int = 8, odds: float = 15.0) -> ToxicityModel:
    """labelled (doc_id, text, toxic) -> a model. per_label bounds the rows of each label that are read (the first by a hash of the id), stems the lexicon."""
    tune(labelled.sparkSession)
    rows = labelled.where("toxic IN (0, 1)").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(11))
    ids = None
    for label in (0, 1):
        part = rows.where(F.col("toxic") == label).select("doc_id", order.alias("o")).orderBy("o", "doc_id").limit(per_label).select("doc_id")
        ids = part if ids is None else ids.unionByName(part)
    sample = materialize(rows.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select("text", "toxic"), "toxic-sample")  # at most 2 * per_label ids
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return ToxicityModel({}, np.zeros(10), np.ones(10), np.array([-30.0] + [0.0] * 10))
    share = F.lit(n[0] / n[1])
    ratio = (F.col("n1") + 0.5) * share / (F.col("n0") + 0.5)
    # a stem counts if it is as over-represented as `odds` says, well beyond chance
    chance = (F.col("n1") - (F.col("n1") + F.col("n0")) * F.lit(n[1] / (n[0] + n[1]))) / F.sqrt((F.col("n1") + F.col("n0")) * F.lit(n[1] * n[0] / (n[0] + n[1]) ** 2))
    found = _stem_counts(sample).where((F.col("n1") >= least) & (ratio >= odds) & (chance >= 4)).select("stem", F.log(ratio).alias("weight"), "n1").orderBy(F.desc(F.col("weight") * F.log1p("n1")), "stem").limit(stems).collect()
    lexicon = Lexicon({r["stem"]: r["weight"] for r in found})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([lexicon.features(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    got = sample.mapInArrow(tidy(run), "x array<double>, toxic int").collect()  # at most 2 * per_label rows of ten numbers
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    return ToxicityModel(lexicon.stems, mean, scale, _fit(np.column_stack([np.ones(len(x)), (x - mean) / scale]), y))


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """documents -> doc_id (or the columns named in `keep`), score, predicted; kept columns of these two names give way to the operator's."""
    tune(docs.sparkSession)
    keep = [c for c in keep or ["doc_id"] if c.lower() not in ("score", "predicted")]
    kinds = dict(docs.dtypes)
    lexicon = Lexicon(model.stems)
    text = keep.index("text") if kinds.get("text") == "string" and "text" in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch.column(text).to_pylist()]).reshape(-1, len(model.mean))
            p = model.probability(x)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double, predicted int"
    read = docs.select(*keep) if text < len(keep) else docs.select(*keep, F.col("text").cast("string").alias("_text"))
    return read.mapInArrow(tidy(run), schema)


def held_out(column: str = "doc_id") -> Column:
    """Rows that labels are never learned from: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows to learn from."""
    known = labels.where(~held_out()).select("doc_id", "toxic").where("toxic IS NOT NULL")
    return docs.select("doc_id", "text").join(known, "doc_id")
