"""Small counting jobs over matches, orders and edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def family_counts(df: DataFrame, keys: Sequence[str], family: str, names: Sequence[str]) -> DataFrame:
    """One count column per named action family."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(family) == n).alias(n) for n in names])


def relation_distribution(edges: DataFrame) -> DataFrame:
    """Edges per relation, per subject table and overall."""
    sets = [["relation"], ["subject_table"], []]
    return edges.groupingSets([[F.col(c) for c in s] for s in sets], F.col("relation"), F.col("subject_table")).agg(
        F.count(F.lit(1)).alias("edges"), F.grouping("relation").alias("all_relations"),
        F.grouping("subject_table").alias("all_tables"))


def race_from_orders(df: DataFrame, game: Column, kind: Column, position: Column,
                     workers: Mapping[str, str]) -> DataFrame:
    """The first worker row decides the race, no worker row gives Random."""
    race = F.create_map(*[F.lit(x) for pair in workers.items() for x in pair])[kind]
    first = F.min_by(race, F.when(race.isNotNull(), position))
    return df.groupBy(game).agg(F.coalesce(first, F.lit("Random")).alias("race"))


def win_summary(matches: DataFrame, bot: str, victory: Column) -> DataFrame:
    """Games, wins and the rest (errors count as losses) per bot and overall."""
    wins = F.count_if(victory)
    return matches.rollup(bot).agg(F.count(F.lit(1)).alias("games"), wins.alias("wins"),
                                   (F.count(F.lit(1)) - wins).alias("losses"))


def task_grid(bots: DataFrame, races: Sequence[str], difficulties: Sequence[str]) -> DataFrame:
    """Every bot against every race and difficulty, numbered in order.

    Races and difficulties are literal lists exploded per bot; the bots of a
    run are a short configured list, ranked in one window.
    """
    bot = bots.columns[0]
    races, difficulties = sorted(races), sorted(difficulties)
    ranked = bots.select(bot).distinct().withColumn("_bot", F.row_number().over(Window.orderBy(bot)) - 1)
    grid = ranked.select("*", F.posexplode(F.array(*[F.lit(r) for r in races])).alias("_r", "race")).select(
        "*", F.posexplode(F.array(*[F.lit(d) for d in difficulties])).alias("_d", "difficulty"))
    number = F.col("_bot") * (len(races) * len(difficulties)) + F.col("_r") * len(difficulties) + F.col("_d")
    return grid.select(bot, "race", "difficulty", number.alias("task"))
