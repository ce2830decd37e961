"""Mixing sources to target weights, with DataFrame operations alone.

Weights are source token shares to a power, normalised; the exponent is found by bisection: the one nearest to 1 whose
weights reach a target entropy (a share of the greatest possible), or the smallest one whose most repeated source stays
within a repetition limit. The token budget defaults to the smallest one that repeats no source less than once, so no
document is lost; a smaller budget samples.

The weights are then realised: each source owes budget x weight tokens, that is some whole passes over its documents and a
part of a pass. Documents are dealt to blocks by a hash; blocks are put in a random order (a permutation of a bounded
number of blocks per source) and taken while they fit the part; within the one block that does not fit, documents are taken
in hash order while they fit. No source is sorted as a whole, so a source of any size is as good as many small ones.

Results for odd inputs: a null source is a source of its own; null and empty texts have no tokens, never count and come
once per whole pass; rows with equal ids are taken alike; an empty table gives no rows; very long texts are one count each.
Columns of the input are kept whatever their names, but for n_tokens and copies, which are the operator's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import aside, materialize, restored


def tokens(column: str = "text") -> Column:
    """White-space separated words."""
    return F.size(F.filter(F.split(F.coalesce(F.col(column).cast("string"), F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).cast("long")


def weights(totals: DataFrame, limit: float | None = 2.0, entropy: float | None = None, budget: int | None = None, rounds: int = 50) -> DataFrame:
    """totals (source, n_tokens) -> source, n_tokens, alpha, weight, owed: one row per source.

    Sources are few next to documents; their totals are one array in one row here, and the bisection is a fold over it.
    """
    if (limit is None) == (entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    some = totals.where("n_tokens > 0")
    one = some.agg(F.array_sort(F.collect_list(F.struct(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s"), F.col("n_tokens").alias("n")))).alias("t"))
    one = one.withColumn("all", F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["n"]))
    one = one.withColumn("p", F.transform("t", lambda x: x["n"] / F.col("all")))
    total = lambda a: F.aggregate("p", F.lit(0.0), lambda s, p: s + F.pow(p, a))

    def most_repeated(a: Column) -> Column:
        """The repetitions of the source that is repeated most; shares p, weights p^a / sum: rounds are p^(a - 1) x budget / (all x sum)."""
        least = F.array_min(F.transform("p", lambda p: F.pow(p, a - 1)))
        most = F.array_max(F.transform("p", lambda p: F.pow(p, a - 1)))
        return most / least if budget is None else most * F.lit(float(budget)) / (F.col("all") * total(a))

    def spread(a: Column) -> Column:
        h = F.aggregate(F.transform("p", lambda p: F.pow(p, a)), F.lit(0.0), lambda s, w: s - w / total(a) * F.ln(w / total(a)))
        return h / F.greatest(F.ln(F.size("p")), F.lit(1e-9))

    # lo never meets the condition (or is 0), hi does (or is 1); a larger exponent repeats less and has less entropy
    def halve(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        good = most_repeated(mid) <= F.lit(limit) if limit is not None else spread(mid) <= F.lit(entropy)
        return F.when(good, F.struct(s["lo"].alias("lo"), mid.alias("hi"))).otherwise(F.struct(mid.alias("lo"), s["hi"].alias("hi")))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    at_zero = most_repeated(F.lit(0.0)) <= F.lit(limit) if limit is not None else spread(F.lit(0.0)) <= F.lit(entropy)
    found = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, halve)["hi"]
    one = one.withColumn("alpha", F.round(F.when(at_zero, F.lit(0.0)).otherwise(found), 9))
    one = one.withColumn("norm", total(F.col("alpha")))
    top = F.array_max("p")
    fitting = F.lit(float(budget)) if budget is not None else F.col("all") * F.pow(top, 1 - F.col("alpha")) * F.col("norm")
    rows = one.withColumn("budget", fitting).select(F.explode("t").alias("x"), "all", "alpha", "norm", "budget")
    weight = F.pow(F.col("x.n") / F.col("all"), F.col("alpha")) / F.col("norm")
    source = F.when(F.col("x.s") != "", F.substring("x.s", 2, 1 << 20))
    return rows.select(source.alias("source"), F.col("x.n").alias("n_tokens"), "alpha", F.round(weight, 9).alias("weight"), F.round(weight * F.col("budget") + 1e-6).cast("long").alias("owed"))


#: Up to this many sources, the tables of one row per source are broadcast (some 50 MB); more are joined by a shuffle.
FEW_SOURCES = 200_000


def _mixed(column: Column, seed: int) -> Column:
    """A hash of an integer column that any engine can compute, 0 to 2^31 - 2."""
    m = 2147483647
    a = F.pmod(F.coalesce(column.cast("long"), F.lit(-1).cast("long")), F.lit(m)) + seed
    for k in (48271, 69621, 16807):
        a = F.pmod(F.pmod(a, F.lit(m)) * k + 12345, F.lit(m))
    return a


def mix_sources(docs: DataFrame, limit: float | None = 2.0, entropy: float | None = None, budget: int | None = None, blocks: int = 1024, seed: int = 7) -> DataFrame:
    """documents -> their rows with n_tokens and copies (how often the mixture has each; 0: left out)."""
    inner, names = aside(docs, ["doc_id", "text", "source"])
    dealt = inner.withColumn("_h", _mixed(F.col("doc_id").cast("long"), seed)).withColumn("_b", (F.col("_h") % blocks).cast("int"))
    rows = dealt.withColumn("_n", tokens())
    sizes = materialize(rows.groupBy("source", "_b").agg(F.sum("_n").alias("_bn")), "blocks")
    plan = materialize(weights(sizes.groupBy("source").agg(F.sum("_bn").alias("n_tokens")), limit, entropy, budget), "weights")
    # whole passes, and what is owed of the last; blocks in a random order, at most `blocks` rows a source
    few = plan.count() <= FEW_SOURCES
    small = F.broadcast if few else lambda df: df
    owed = sizes.join(small(plan.select(F.col("source").alias("_s"), "n_tokens", "owed")), F.col("source").eqNullSafe(F.col("_s")))
    order = Window.partitionBy("source").orderBy(_mixed(F.col("_b"), seed + 1), "_b")
    before = F.coalesce(F.sum("_bn").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = owed.select(F.col("source").alias("_s"), F.col("_b").alias("_k"), F.expr("owed div n_tokens").alias("_full"), (F.expr("owed % n_tokens") - before).alias("_left"), F.col("_bn").alias("_size"))
    placed = materialize(placed, "placed")
    # at most blocks x sources rows: a map of fixed size per source, however many documents there are
    joined = rows.join(F.broadcast(placed) if placed.count() <= 1_000_000 else placed, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_k")), "left")
    cut = (F.col("_left") > 0) & (F.col("_left") < F.col("_size"))
    edge = dealt.join(small(placed.where(cut).select("_s", "_k", "_left")), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_k")))
    edge = edge.select("_s", "_k", "_h", tokens().alias("_n"), "_left")
    inner = Window.partitionBy("_s", "_k").orderBy("_h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    upto = edge.withColumn("_sum", F.sum("_n").over(inner)).where("_sum <= _left").groupBy("_s", "_k").agg(F.max("_h").alias("_last"))
    last = materialize(upto.select(F.col("_s").alias("_s2"), F.col("_k").alias("_k2"), "_last"), "last")
    joined = joined.join(small(last), F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_k") == F.col("_k2")), "left")
    part = F.when(F.col("_left") >= F.col("_size"), 1).when(F.col("_left") > 0, F.when(F.col("_h") <= F.col("_last"), 1).otherwise(0)).otherwise(0)
    copies = F.coalesce(F.col("_full") + F.when(F.col("_n") > 0, part).otherwise(0), F.lit(1)).cast("long")
    return joined.select(*restored(names, ["n_tokens", "copies"]), F.col("_n").alias("n_tokens"), copies.alias("copies"))
