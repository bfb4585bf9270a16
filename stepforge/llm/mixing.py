"""Mixing sources to target weights by temperature.

Weights are the sources' token shares raised to an exponent between 0 (all
alike) and 1 (as they are), normalised. The exponent is found by narrowing
an interval: each round evaluates a grid of exponents in one aggregate over the
table of sources, which never leaves the cluster. The budget of tokens is the
least that gives every source its weight without dropping any of its
documents, or a given one. A source's quota is realised as whole passes over its
documents and part of one more: its documents are dealt to blocks, the blocks
are permuted by a seeded hash, whole blocks are taken while they fit, and of the
next one the documents in hash order that fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepforge.llm.common import Scratch, spare

GRID, ROUNDS = 33, 5


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def exponent(shares: DataFrame, entropy: float | None, repeats: float | None, budget: float | None) -> tuple[float, float]:
    """``(exponent, budget)`` for sources ``(p, tokens)`` with p > 0.

    With ``entropy`` the largest exponent whose weights reach that share of the
    largest possible entropy; with ``repeats`` the smallest whose sources
    are passed over at most so often. Both grow or fall with the exponent alone.
    """
    low, high = 0.0, 1.0
    whole = shares.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    if not whole.t:
        return 1.0, 0.0

    def measured(grid: list[float]) -> list[tuple[float, float, float]]:
        cells = []
        for i, a in enumerate(grid):
            power = F.pow("p", F.lit(a))
            cells += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log("p")).alias(f"s{i}"), F.max(F.pow("p", F.lit(1.0 - a))).alias(f"m{i}"),
                      F.min(F.pow("p", F.lit(1.0 - a))).alias(f"l{i}")]
        row = shares.agg(*cells).first()
        out = []
        for i, a in enumerate(grid):
            z, s, most, least = (row[f"{c}{i}"] for c in "zsml")
            tokens = float(budget) if budget is not None else whole.t * z * most
            out.append((math.log(z) - a * s / z, tokens / (whole.t * z * least), tokens))
        return out

    def good(entropy_now: float, repeats_now: float) -> bool:
        """Holds up to some exponent for an entropy, from some exponent on for repeats."""
        if entropy is not None:
            return entropy_now >= entropy * math.log(max(whole.n, 1)) - 1e-12
        return repeats_now <= repeats + 1e-9

    if entropy is None and repeats is None:
        return 1.0, measured([1.0])[0][2]
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / (GRID - 1) for i in range(GRID)]
        fits = [good(h, r) for h, r, _ in measured(grid)]
        if entropy is not None:
            at = max((i for i, ok in enumerate(fits) if ok), default=0)
            low, high = grid[at], grid[min(at + 1, GRID - 1)]
        else:
            at = min((i for i, ok in enumerate(fits) if ok), default=GRID - 1)
            low, high = grid[max(at - 1, 0)], grid[at]
    final = low if entropy is not None else high
    return final, measured([final])[0][2]


def mix(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", entropy: float | None = None,
        repeats: float | None = 2.0, budget: float | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``df`` with ``n_tokens``, ``weight`` (of the source) and ``copies`` (how often to take the row).

    Tokens are words. Without ``budget`` no row has fewer than one copy. A null
    source is a source of its own; null and empty texts have no tokens and as
    many copies as whole passes over their source; a source without tokens is
    taken once, with weight 0. Repeated rows are drawn alike. Columns named
    like an added one are replaced, all others kept.
    """
    scratch = Scratch(df.sparkSession)
    hashed = F.xxhash64(F.col(id_col), F.col(text_col))
    key, plan_name, of = spare(df, "_h", "_plan", "_of")
    rows = df.drop("n_tokens", "weight", "copies").withColumns({"n_tokens": word_count(text_col), key: hashed})
    slim = scratch.cut(rows.select(F.col(source_col).alias("src"), F.col("n_tokens").alias("tok"), F.col(key).alias("h")))
    sources = scratch.cut(slim.groupBy("src").agg(F.sum("tok").alias("tokens"), F.count("*").alias("rows")))
    total = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first().t
    shares = sources.filter("tokens > 0").select("src", "tokens", "rows", (F.col("tokens") / F.lit(float(max(total, 1)))).alias("p"))
    power, size = exponent(shares, entropy, repeats, budget)
    norm = shares.agg(F.sum(F.pow("p", F.lit(power))).alias("z")).first().z or 1.0
    weight = F.pow("p", F.lit(power)) / F.lit(norm)
    quota = shares.select("src", "tokens", F.ceil(F.sqrt("rows")).cast("int").alias("blocks"), weight.alias("weight")).withColumn(
        "passes", F.floor(F.col("weight") * F.lit(size) / F.col("tokens") + 1e-9).cast("int")).withColumn(
        "rest", F.col("weight") * F.lit(size) - F.col("passes") * F.col("tokens"))
    quota = scratch.cut(quota)

    def block(h: str) -> Column:
        return F.pmod(F.col(h), F.col("blocks")).cast("int")

    def turn(b: str, src: str) -> Column:
        return F.xxhash64(F.lit(seed), F.col(src), F.col(b))

    dealt = slim.join(quota.withColumnRenamed("src", "_src"), F.col("src").eqNullSafe(F.col("_src"))).select(
        "src", "tok", "h", "rest", block("h").alias("b")).withColumn("turn", turn("b", "src"))
    sums = scratch.cut(dealt.groupBy("src", "turn", "rest").agg(F.sum("tok").alias("tok")))
    before = Window.partitionBy("src").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    walked = sums.withColumn("before", F.coalesce(F.sum("tok").over(before), F.lit(0)))
    # The block in which the quota ends; at most one per source.
    ends = scratch.cut(walked.filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("tok") > F.col("rest"))).select(
        F.col("src").alias("_src"), F.col("turn").alias("_turn"), (F.col("rest") - F.col("before")).alias("room")))
    inside = Window.partitionBy("src").orderBy("order", "h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = dealt.join(ends, F.col("src").eqNullSafe(F.col("_src")) & (F.col("turn") == F.col("_turn"))).withColumn(
        "order", F.xxhash64(F.lit(seed + 1), F.col("h"))).withColumn("sum", F.sum("tok").over(inside)).filter("sum <= room")
    cutoff = last.groupBy("src").agg(F.max("order").alias("upto"))
    plan = quota.join(ends, quota["src"].eqNullSafe(ends["_src"]), "left").drop("_src").join(
        cutoff.withColumnRenamed("src", "_src"), F.col("src").eqNullSafe(F.col("_src")), "left").select(
        F.col("src").alias(of), F.struct("blocks", "weight", "passes", F.col("_turn").alias("turn"), "upto").alias(plan_name))
    plan = scratch.cut(plan)
    scratch.free(slim, sources, sums, ends, quota)
    out = rows.join(plan, F.col(source_col).eqNullSafe(F.col(of)), "left")
    h, its = F.col(key), lambda name: F.col(plan_name)[name]
    own = F.xxhash64(F.lit(seed), F.col(source_col), F.pmod(h, its("blocks")).cast("int"))
    more = F.when(its("turn").isNull(), F.lit(False)).when(own < its("turn"), F.lit(True)).when(
        own == its("turn"), F.coalesce(F.xxhash64(F.lit(seed + 1), h) <= its("upto"), F.lit(False))).otherwise(F.lit(False))
    return out.withColumns({"weight": F.coalesce(its("weight"), F.lit(0.0)),
                            "copies": F.when(its("passes").isNull(), 1).otherwise(its("passes") + more.cast("int"))}).drop(key, of, plan_name)
