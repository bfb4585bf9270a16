"""Ranking of candidate executors of a prompt; all ties for the best rank are golden."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.functions.text import bind

# Add-on tiers and ready scores.
ADDON_TIER = {"reactor": 3, "techlab": 2, "other": 1, "none": 0}
IDLE_SCORE, REACTOR_BONUS, BUSY_REACTOR_FLOOR = 1000.0, 1.0, 500.0
# Producers that can carry an add-on.
ADDON_HOSTS = ["BARRACKS", "FACTORY", "STARPORT"]


def is_addon(action: Column) -> Column:
    return F.rlike(action, F.lit("^BUILD_(TECHLAB|REACTOR)_"))


def is_upgrade(action: Column) -> Column:
    return action.startswith("UPGRADETO")


def reserved_hosts(conflicts: Column) -> Column:
    """Types that pending add-on and upgrade actions will need."""
    def host(action):
        return F.when(is_addon(action), F.element_at(F.split(action, "_"), -1)).when(is_upgrade(action), "COMMANDCENTER")

    return F.array_distinct(F.array_compact(F.transform(conflicts, host)))


def ready_score(idle: Column, progress: Column, addon: Column) -> Column:
    reactor = addon == "reactor"
    busy = progress * IDLE_SCORE
    busy = F.when(reactor & (progress < 0.5), F.greatest(busy, F.lit(BUSY_REACTOR_FLOOR))).otherwise(busy)
    return (F.when(idle, F.when(reactor, IDLE_SCORE + REACTOR_BONUS).otherwise(IDLE_SCORE))
            .when(progress.isNotNull(), busy).otherwise(0.0))


def addon_tier(addon: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in ADDON_TIER.items() for x in pair])[addon]


def filter_reason(unit: Column, addon: Column, reserved: Column, ability: Column) -> Column:
    """Why a candidate is kept back, empty if it is not."""
    off = (F.size(reserved) == 0) | is_addon(ability) | is_upgrade(ability)
    bare = unit.isin(*ADDON_HOSTS) & (addon == "none") & F.array_contains(reserved, unit)
    base = (unit == "COMMANDCENTER") & F.array_contains(reserved, F.lit("COMMANDCENTER"))
    return (F.when(off, "").when(bare, F.concat(F.lit("reserve bare "), unit, F.lit(" for pending add-on")))
            .when(base, "reserve unupgraded COMMANDCENTER for pending base upgrade").otherwise(""))


def score_candidates(candidates: DataFrame, prompts: DataFrame) -> DataFrame:
    """Candidates with reason, eligibility and rank key. ``prompts`` has prompt, ability, conflicts."""
    hosts = prompts.select("prompt", "ability", reserved_hosts(F.col("conflicts")).alias("reserved"))
    rows = candidates.join(hosts, "prompt")
    reason = filter_reason(F.col("unit"), F.col("addon"), F.col("reserved"), F.col("ability"))
    rows = rows.withColumn("reason", reason).withColumn("eligible", reason == "").withColumn(
        "ready", ready_score(F.col("is_idle"), F.col("progress"), F.col("addon")))
    return rows.withColumn("rank_key", F.struct(
        "eligible", "ready", addon_tier(F.col("addon")).alias("addon_tier"), F.col("tier").alias("base_tier")))


def golden_rank(candidates: DataFrame, prompts: DataFrame) -> DataFrame:
    """Add ``golden`` and the prompt's ``reservation`` and ``fallback``.

    The best key per prompt is a plain maximum, combined before the shuffle;
    eligibility leads the key, so a best key that is not eligible is the
    fallback over all candidates.
    """
    scored = score_candidates(candidates, prompts)
    best = scored.groupBy("prompt").agg(F.max("rank_key").alias("_best"))
    return scored.join(best, "prompt").withColumn("golden", F.col("rank_key") == F.col("_best")).withColumn(
        "reservation", F.size("reserved") > 0).withColumn("fallback", ~F.col("_best.eligible")).drop("_best")


def golden_tags(candidates: Column, ability: Column, conflicts: Column) -> Column:
    """``golden_tags`` (ascending), ``reservation`` and ``fallback`` of a prompt whose candidates are in its row.

    The rule of ``golden_rank`` without an exchange. ``candidates`` is an array of (tag, unit, idle, progress,
    addon, tier); a prompt without any has null.
    """
    def keyed(v):
        def entry(c):
            key = F.struct((filter_reason(c["unit"], c["addon"], v["reserved"], v["ability"]) == "").alias("eligible"),
                           ready_score(c["idle"], c["progress"], c["addon"]).alias("ready"),
                           addon_tier(c["addon"]).alias("addon_tier"), c["tier"].alias("base_tier"))
            return F.struct(key.alias("key"), c["tag"].alias("tag"))

        return F.struct(F.transform(v["candidates"], entry).alias("all"), (F.size(v["reserved"]) > 0).alias("reservation"))

    def best(v):
        return F.struct(F.array_max(F.transform(v["all"], lambda e: e["key"])).alias("best"), v["all"].alias("all"), v["reservation"].alias("reservation"))

    def result(v):
        golden = F.transform(F.filter(v["all"], lambda e: e["key"] == v["best"]), lambda e: e["tag"])
        return F.when(F.size(v["all"]) > 0, F.struct(
            F.array_sort(F.array_compact(golden)).alias("golden_tags"), v["reservation"].alias("reservation"), (~v["best"]["eligible"]).alias("fallback")))

    begin = F.struct(candidates.alias("candidates"), ability.alias("ability"), reserved_hosts(conflicts).alias("reserved"))
    return bind(bind(bind(begin, keyed), best), result)


def golden_prompts(ranked: DataFrame) -> DataFrame:
    """One row per prompt: golden count and the two flags."""
    return ranked.groupBy("prompt").agg(
        F.count_if("golden").alias("golden"), F.max("reservation").alias("reservation"), F.max("fallback").alias("fallback"))
