"""Detection of an opponent's opening from what each frame shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def protoss_rush() -> Column:
    """Columns: time, nexuses, expanded, near_robo, near_gates, core, only_main, gates, robos, gas."""
    c, early = F.col, F.col("time") < 125
    hidden = (c("time") > 110) & (c("near_gates") == 0) & ~c("core") & c("only_main")
    many = F.when(c("gas") == 1, "AdeptRush").when(c("gas") == 0, "Zealots")
    opening = (F.when((c("gates") > 2), many).when(c("gates") + c("robos") > 2, "RoboRush"))
    return (F.when((c("nexuses") > 1) | c("expanded"), "Macro").when(c("near_robo"), "ProxyRobo")
            .when(early, F.coalesce(opening, F.when(hidden, "ProxyZealots"))))


def terran_rush() -> Column:
    """Columns: time, expanded, only_main, barracks, near_barracks, techlabs, factories."""
    c = F.col
    marauders = (c("techlabs") == c("barracks")) & (c("barracks") >= 1) & (c("factories") == 0)
    hidden = (c("time") > 110) & (c("near_barracks") == 0) & (c("factories") == 0) & c("only_main")
    return F.when(c("expanded"), "Macro").when(c("time") < 120, F.when(marauders, "Marauders").when(
        hidden, "ProxyRax").when(c("barracks") + c("factories") > 2, "OneBaseRax"))


def zerg_rush() -> Column:
    """Columns: time, hatcheries, enemy_workers, roaches, zerglings and start times (null if unseen)."""
    c = F.col

    def before(name, limit):
        return F.coalesce(c(name) < limit, F.lit(False))

    return (F.when((c("hatcheries") > 2) | (c("enemy_workers") > 20), "Macro")
            .when(before("warren_start", 130) | ((c("time") < 160) & (c("roaches") > 0)), "RoachRush")
            .when(before("pool_start", 26), "Pool12").when(before("pool_start", 40), "PoolFirst")
            .when((c("time") > 120) & (c("time") < 130) & (c("hatcheries") == 1) & before("pool_start", 70),
                  "OneHatcheryAllIn")
            .when((c("zerglings") > 0) & (c("time") < 92), "Pool12")
            .when(before("second_hatchery", 50) & before("extractor_start", 70) & before("pool_start", 70)
                  & (c("enemy_workers") < 17), "HatchPool15_14"))


def rush_detect(frames: DataFrame, game: Sequence[str], race_rule: Column, order: Sequence[str]) -> DataFrame:
    """Final verdict per game.

    A frame says what its race's rules say, else a worker rush when more than
    nine enemy workers are near. Frames after 180 s do not count. A frame that
    ends as a worker rush is final; otherwise the last verdict stands.
    """
    value = F.coalesce(race_rule, F.when(F.col("workers_close") > 9, "WorkerRush"))
    frames = frames.filter(F.col("time") <= 180).withColumn("_v", value)
    verdict = frames.groupBy(*game).agg(
        F.bool_or(F.col("_v") == "WorkerRush").alias("_w"),
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_last"))
    return verdict.select(*game, F.when(F.col("_w"), "WorkerRush").otherwise(
        F.coalesce("_last", F.lit("Start"))).alias("rush"))


def macro_rule() -> Column:
    """Columns: race, time, marker (the telling unit present), marines, marauders, medivacs."""
    c, early = F.col, F.col("time") < 420
    names = {"BATTLECRUISER": "BattleCruisers", "BANSHEE": "Banshees", "TEMPEST": "Tempests", "CARRIER": "Carriers",
             "DARKTEMPLAR": "DarkTemplars", "MUTALISK": "Mutalisks", "LURKERMP": "Lurkers"}
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[c("marker")]
    bio = ((c("race") == "Terran") & (c("time") > 420) & (c("time") < 480) & (c("marines") > c("marauders"))
           & (c("marauders") > 15) & (c("medivacs") < 15) & (c("medivacs") > 0))
    return F.when(early & named.isNotNull(), named).when(bio, "Mmm")


def macro_detect(frames: DataFrame, game: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first frame with a match decides; a game without one is standard."""
    value = macro_rule()
    first = F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return frames.groupBy(*game).agg(F.coalesce(first, F.lit("StandardMacro")).alias("macro"))
