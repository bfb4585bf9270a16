"""Resampling by answer multiset with step targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.operators.keyed import first_per_key
from stepforge.operators.ordered import numbered
from stepforge.session import cut_lineage


def step_balance(rows: DataFrame, step: str) -> DataFrame:
    """Least, greatest, their ratio and the population deviation of rows per step."""
    per_step = rows.groupBy(step).agg(F.count(F.lit(1)).alias("n"))
    return per_step.agg(
        F.min("n").cast("double").alias("min"), F.max("n").cast("double").alias("max"),
        F.round(F.max("n") / F.min("n"), 6).alias("ratio"), F.round(F.stddev_pop("n"), 6).alias("std"))


# Least frequency and cap or ratio of each tier.
TIERS = {"t0_min": 50, "t0_cap": 25, "t1_min": 30, "t1_cap": 15, "t2_min": 10, "t2_ratio": 0.5, "t3_min": 5,
         "t3_ratio": 0.75, "t4_ratio": 1.0}
LEAST_SUPPLY = 5


def cap_for_freq(freq: Column, cfg: dict = TIERS) -> Column:
    """Rows a multiset of this frequency may keep."""
    share = lambda ratio: F.greatest(F.lit(1).cast("bigint"), F.ceil(freq * ratio))
    return (F.when(freq >= cfg["t0_min"], F.least(freq, F.lit(cfg["t0_cap"])))
            .when(freq >= cfg["t1_min"], F.least(freq, F.lit(cfg["t1_cap"])))
            .when(freq >= cfg["t2_min"], share(cfg["t2_ratio"])).when(freq >= cfg["t3_min"], share(cfg["t3_ratio"]))
            .when(freq >= 2, share(cfg["t4_ratio"])).otherwise(freq))


def tier_of(freq: Column, cfg: dict = TIERS) -> Column:
    return (F.when(freq >= cfg["t0_min"], "T0").when(freq >= cfg["t1_min"], "T1").when(freq >= cfg["t2_min"], "T2")
            .when(freq >= cfg["t3_min"], "T3").when(freq >= 2, "T4").otherwise("T5_singleton"))


def step_targets(rows: DataFrame, total: int, alpha: float) -> DataFrame:
    """Float target per step: a blend of flat and proportional shares, capped by supply."""
    supply = rows.groupBy("step").agg(F.count(F.lit(1)).alias("supply"))
    # One row per step number: steps of a game are few, so these windows are small.
    every = Window.partitionBy()
    eligible = F.col("supply") >= LEAST_SUPPLY
    fitting = F.sum(eligible.cast("int")).over(every)
    flat = F.lit(float(total)) / F.when(fitting > 0, fitting).otherwise(F.count(F.lit(1)).over(every))
    share = F.col("supply") / F.sum("supply").over(every) * total
    blend = F.when(eligible, alpha * flat + (1.0 - alpha) * share).otherwise(share)
    capped = supply.withColumn("target", F.least(blend, F.col("supply").cast("double")))
    summed = F.sum("target").over(every)
    scaled = F.when(summed > total, F.greatest(F.lit(1.0), F.col("target") * total / summed)).otherwise(F.col("target"))
    return capped.select("step", "supply", scaled.alias("target"))


def largest_remainder(targets: DataFrame, total: int) -> DataFrame:
    """Integer targets that sum to ``total`` as far as three rounds of additions allow.

    Additions go by falling remainder (higher step first on ties). Take-backs,
    when floors exceed the total, go one by one to the step that is furthest
    below its float target, and stop at a step that is down to one.
    """
    every = Window.partitionBy()
    floors = targets.withColumn("base", F.floor("target")).withColumn("_sum", F.sum(F.floor("target")).over(every))
    by_rest = Window.orderBy(F.desc(F.col("target") - F.floor("target")), F.desc("step"))
    placed = floors.withColumn("_at", F.row_number().over(by_rest)).withColumn("_n", F.count(F.lit(1)).over(every))
    missing = F.greatest(F.lit(0).cast("bigint"), F.least(F.lit(total) - F.col("_sum"), F.col("_n") * 3))
    added = F.floor(missing / F.col("_n")) + F.when(F.col("_at") <= missing % F.col("_n"), 1).otherwise(0)
    grown = placed.select("step", "target", (F.col("base") + added).alias("units"))
    over = F.greatest(F.lit(0).cast("bigint"), F.sum("units").over(every) - total)
    listed = grown.withColumn("_over", over).agg(
        F.max("_over").alias("over"), F.array_sort(F.collect_list(F.struct("step", "target", "units"))).alias("rows"))

    def take(state, _):
        rows = state["rows"]
        worst = F.array_min(F.transform(rows, lambda r: F.struct(
            (r["units"] - r["target"]).alias("gap"), r["step"].alias("step"), r["units"].alias("units"))))
        stop = state["stop"] | (worst["units"] <= 1)
        less = F.transform(rows, lambda r: F.struct(r["step"].alias("step"), r["target"].alias("target"), F.when(
            r["step"] == worst["step"], r["units"] - 1).otherwise(r["units"]).alias("units")))
        return F.struct(F.when(stop, rows).otherwise(less).alias("rows"), stop.alias("stop"))

    begin = F.struct(F.col("rows"), F.lit(False).alias("stop"))
    rounds = F.when(F.col("over") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("over"))).otherwise(
        F.array().cast("array<bigint>"))
    return listed.select(F.inline(F.aggregate(rounds, begin, take)["rows"])).select("step", "target", "units")


def dedupe_summary(rows: DataFrame) -> DataFrame:
    """One record per summary within a multiset: highest step, first wins ties."""
    return first_per_key(rows, ["multiset", "summary"], [-F.col("step"), F.col("index")])


def _slices() -> Column:
    return F.shiftright(F.col("_h"), 48)


def _room(steps: DataFrame, chosen: DataFrame | None) -> DataFrame:
    """``(step, room)`` of steps that lack rows; one row per step number."""
    if chosen is None:
        return steps.select("step", F.col("units").alias("room")).filter("room > 0")
    taken = chosen.groupBy("step").agg(F.count(F.lit(1)).alias("taken"))
    return steps.join(taken, "step", "left").select(
        "step", (F.col("units") - F.coalesce("taken", F.lit(0))).alias("room")).filter("room > 0")


def one_per_multiset(known: DataFrame, steps: DataFrame) -> DataFrame:
    """One row of every multiset, in a step that lacks rows where it has such a one.

    In each round a multiset that waits draws a step among those with room, by
    weight of the room, and a step admits as many as it has room for. A round
    fills a step or admits all that asked, so there are at most as many rounds
    as steps and one more. Multisets whose steps are all full then take their
    row of the largest target.
    """
    chosen, rounds = None, 0
    while True:
        waiting = known if chosen is None else known.join(chosen.select("multiset"), "multiset", "left_anti")
        drawn = (F.pmod(F.xxhash64(F.lit(rounds), "_h"), F.lit(1 << 53)) + 0.5) / float(1 << 53)
        asked = first_per_key(waiting.join(_room(steps, chosen), "step"), ["multiset"], [
            -F.ln(drawn) / F.col("room"), F.col("_h"), F.col("index")])
        admitted = cut_lineage(numbered(asked, ["step"], ["_h", "index"], _slices(), "_n").filter("_n < room").select(
            "index", "step", "multiset"))
        if admitted.isEmpty():
            break
        chosen, rounds = admitted if chosen is None else chosen.unionByName(admitted), rounds + 1
    units = waiting.join(steps, "step", "left").withColumn("units", F.coalesce("units", F.lit(0)))
    rest = first_per_key(units, ["multiset"], [-F.col("units"), F.col("_h"), F.col("index")]).select("index", "step", "multiset")
    return cut_lineage(rest if chosen is None else chosen.unionByName(rest))


def multiset_resample(rows: DataFrame, targets: DataFrame, seed: int, soft_max: int | None = None) -> DataFrame:
    """Selected rows: one per multiset, then steps filled up within multiset caps.

    ``rows`` has index, step, summary, multiset; ``targets`` has step, units.
    Every multiset keeps one row, no multiset exceeds its cap, and rows beyond
    the first pass only fill what a step still lacks. The second pass ends when
    every row left has a full step or a multiset at its cap: each round lets a
    multiset offer as many rows as it may still keep, then a step takes as many as
    it lacks, so that afterwards each multiset is at its cap or one of its steps
    is full. ``soft_max`` bounds all rows selected, except that the first pass is whole. Rows are ordered by
    a seeded hash where a generator would draw. Rounds run when the plan is built.
    """
    freq = rows.groupBy("multiset").agg(F.count(F.lit(1)).alias("freq"))
    known = cut_lineage(dedupe_summary(rows).join(freq, "multiset").select(
        "index", "step", "summary", "multiset", cap_for_freq(F.col("freq")).alias("cap"), F.xxhash64(F.lit(seed), "index").alias("_h")))
    steps, ids = cut_lineage(targets.select("step", "units")), known.drop("summary")
    chosen = one_per_multiset(ids.drop("cap"), steps).withColumn("pass", F.lit(1))
    while True:
        kept = chosen.groupBy("multiset").agg(F.count(F.lit(1)).alias("kept"))
        left = ids.join(chosen.select("index"), "index", "left_anti").join(_room(steps, chosen), "step").join(kept, "multiset").filter(
            "kept < cap")
        offered = numbered(left, ["multiset"], ["_h", "index"], _slices(), "_in").filter("_in + kept < cap")
        fill = numbered(offered, ["step"], ["_in", "_h", "index"], F.col("_in") * 65536 + _slices() + 32768, "_fill").filter("_fill < room")
        if soft_max is not None:
            fill = numbered(fill.withColumn("_all", F.lit(0)), ["_all"], ["_h", "index"], _slices(), "_n").filter(
                F.col("_n") < soft_max - chosen.count())
        added = cut_lineage(fill.select("index", "step", "multiset", F.lit(2).alias("pass")))
        if added.isEmpty():
            break
        chosen = chosen.unionByName(added)
    return known.select("index", "step", "summary", "multiset").join(chosen.select("index", "pass"), "index")


def resample_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, multisets, dropped rows per tier and the share of late steps, before and after."""
    old = before.groupBy("multiset").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("step") >= 16).alias("late"))
    new = after.groupBy("multiset").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("step") >= 16).alias("kept_late"))
    both = old.join(new, "multiset", "left").na.fill(0, ["m", "kept_late"]).withColumn("tier", tier_of(F.col("n")))
    share = lambda part, whole: F.round(100 * F.sum(part) / F.sum(whole), 2)
    return both.rollup("tier").agg(
        F.sum("n").alias("original"), F.sum("m").alias("kept"), (F.sum("n") - F.sum("m")).alias("dropped"),
        F.count(F.lit(1)).alias("multisets"), share("late", "n").alias("late_before"), share("kept_late", "m").alias("late_after"))


def top_multisets(rows: DataFrame, n: int = 15) -> DataFrame:
    """Most common multisets with their percentage of all rows."""
    counted = rows.groupBy("multiset").agg(F.count(F.lit(1)).alias("count"))
    most = counted.orderBy(F.desc("count"), "multiset").limit(n).select("multiset", "count")
    # The total is one row beside the few that are listed.
    total = counted.agg(F.lit(None).cast("string").alias("multiset"), F.sum("count").alias("count"))
    both = most.withColumn("_all", F.lit(False)).unionByName(total.withColumn("_all", F.lit(True)))
    whole = F.max(F.when(F.col("_all"), F.col("count"))).over(Window.partitionBy())
    return both.withColumn("_whole", whole).filter("NOT _all").select(
        "multiset", "count", F.round(100 * F.col("count") / F.col("_whole"), 2).alias("pct"))
