"""Mixing sources to target weights by temperature, with built-in DataFrame functions only.

A source with the share p of all tokens gets the weight p^t / sum(p^t). The exponent t is bisected between 1 (as they
come) and 0 (all alike): the largest t whose weights have at least the target entropy, or the smallest t at which no
source is repeated more often than the limit allows; with both given, the repetition limit goes first. The weights are
realised over a budget of tokens: whole passes over a source, and for the rest a prefix of a permutation of its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialise


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")


def place(seed: int, *of: str) -> Column:
    """A row's place in a permutation: the first 60 bits of an MD5 digest, which SQL engines agree on."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in of])), 1, 15), 16, 10).cast("long")


def solve_exponent(sources: DataFrame, budget: float, entropy: float | None = None, repetition: float | None = None, steps: int = 6) -> float:
    """The exponent for ``sources`` (``source, tokens``); only single numbers come to the driver.

    ``entropy`` is a fraction of the greatest possible one. Each step tries 31 exponents at once, which halves the
    interval five times. Without tokens, with fewer than two sources or
    without a target it is 1; sources without tokens are passed over, null is a source of its own.
    """
    whole = sources.agg(F.sum("tokens"), F.count("*")).first()
    total, n = float(whole[0] or 0), whole[1]
    if total <= 0 or n < 2 or (entropy is None and repetition is None):
        return 1.0
    p = F.col("tokens") / F.lit(total)
    lo, hi = 0.0, 1.0

    def measured(ts: list[float]):
        """For each exponent: sum(p^t), sum(p^t ln p^t), max(p^t / tokens)."""
        cols = []
        for t in ts:
            w = F.pow(p, F.lit(t))
            cols += [F.sum(w), F.sum(w * F.lit(t) * F.log(p)), F.max(w / F.col("tokens"))]
        got = sources.filter("tokens > 0").agg(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
        return [tuple(got[3 * i : 3 * i + 3]) for i in range(len(ts))]

    import math

    def good(m) -> bool:
        z, zlog, most = m
        if repetition is not None:
            return budget * most / z <= repetition
        return math.log(z) - zlog / z >= entropy * math.log(n)

    # repetition falls as t grows, entropy grows as t falls: one end is always the good one
    good_end = 1.0 if repetition is not None else 0.0
    if good(measured([1.0 - good_end])[0]):
        return 1.0 - good_end
    for _ in range(steps):
        ts = [lo + (hi - lo) * k / 32 for k in range(1, 32)]
        fine = [good(m) for m in measured(ts)]
        edge = [lo, *ts, hi]
        if good_end == 1.0:
            k = next((i for i, ok in enumerate(fine) if ok), 31)
            lo, hi = edge[k], edge[k + 1]
        else:
            k = next((i for i, ok in enumerate(fine) if not ok), 31)
            lo, hi = edge[k], edge[k + 1]
    return hi if good_end == 1.0 else lo


def mix(
    docs: DataFrame, budget_share: float = 1.0, entropy: float | None = None, repetition: float | None = 2.0,
    seed: int = 7, block_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``doc_id, source, n_tokens, weight, copies`` for each document: how often the mix takes it, 0 included.

    The budget is ``budget_share`` of all tokens (whitespace words). Null is a source of its own. A document without
    words is taken as often as its source's whole passes, once at least. Where repeated rows or null ids tie in the
    permutation they are taken together. An empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("n_tokens"))
    own = materialise(own)
    # a source is summed in salted parts before its total, and its blocks follow its size
    sources = materialise(own.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    total = float(sources.agg(F.sum("tokens")).first()[0] or 0)
    budget = budget_share * total
    t = solve_exponent(sources, budget, entropy, repetition)
    raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total or 1.0), F.lit(t))).otherwise(0.0)
    z = float(sources.agg(F.sum(raw)).first()[0] or 1.0)
    plan = sources.select(
        F.col("source").alias("plan_source"), "tokens", (raw / F.lit(z)).alias("weight"),
        F.ceil((F.col("tokens") + 1) / F.lit(block_tokens)).cast("long").alias("blocks"),
    )
    wanted = F.round(F.col("weight") * F.lit(budget)).cast("long")
    plan = plan.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(wanted / F.col("tokens"))).otherwise(1).cast("long"))
    plan = materialise(plan.withColumn("part", wanted - F.col("passes") * F.col("tokens")))
    placed = own.join(plan, own.source.eqNullSafe(plan.plan_source)).withColumn("at", place(seed, "doc_id", "source"))
    placed = placed.withColumn("block", F.pmod("at", "blocks"))
    # blocks in permuted order; whole blocks are in or out, the one on the border is cut inside
    blocks = placed.groupBy("plan_source", "block", "part").agg(F.sum("n_tokens").alias("block_sum"))
    ordered = W.partitionBy("plan_source").orderBy(place(seed + 1, "block"), "block").rowsBetween(W.unboundedPreceding, 0)
    blocks = blocks.withColumn("upto", F.sum("block_sum").over(ordered))
    fate = F.when(F.col("upto") <= F.col("part"), 1).when(F.col("upto") - F.col("block_sum") >= F.col("part"), 0).otherwise(2)
    blocks = materialise(blocks.select(F.col("plan_source").alias("s"), F.col("block").alias("k"), fate.alias("fate"), (F.col("part") - F.col("upto") + F.col("block_sum")).alias("room")).filter("fate > 0"))
    joined = placed.join(blocks, placed.plan_source.eqNullSafe(blocks.s) & (placed.block == blocks.k), "left")
    kept = ["doc_id", "source", "n_tokens", "weight", "passes", "fate"]
    border = joined.filter("fate = 2").withColumn("used", F.sum("n_tokens").over(W.partitionBy("source", "block").orderBy("at")))
    inside = border.select(*kept, (F.col("used") <= F.col("room")).cast("int").alias("more"))
    rest = joined.filter("fate is null or fate = 1").select(*kept, F.coalesce(F.col("fate"), F.lit(0)).alias("more"))
    both = rest.unionByName(inside)
    copies = F.when(F.col("n_tokens") > 0, F.col("passes") + F.col("more")).otherwise(F.greatest("passes", F.lit(1)))
    return both.select("doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), copies.cast("long").alias("copies"))
