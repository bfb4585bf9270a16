"""Picking a few rows of many, and the last word per key.

Whole-table picks are an order and a limit, which Spark cuts to the rows wanted in
every task before one task merges them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.operators.keyed import top_per_key


def take(rows: DataFrame, n: int, order: Sequence[Column], first: Column | None = None) -> DataFrame:
    """The first ``n`` rows in order; those that ``first`` holds for come before all others."""
    return rows.orderBy(*([first.desc()] if first is not None else []), *order).limit(n)


def random_group(rows: DataFrame, n: int, id_col: str, seed: int) -> DataFrame:
    """``n`` rows by a seeded hash of their id: the same ones in every run."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    return rows.orderBy(draw, id_col).limit(n)


def furthest(points: DataFrame, x: float, y: float, k: int, tie: str, keys: Sequence[str] = ()) -> DataFrame:
    """The ``k`` points of each key farthest from a place, with ``d2``; ties by ``tie``."""
    far = points.withColumn("d2", (F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y))
    return top_per_key(far, list(keys), [F.desc("d2"), F.col(tie)], k)


def nearest_to_distance(points: DataFrame, x: float, y: float, distance: float, n: int, tie: str, digits: int = 6) -> DataFrame:
    """The ``n`` points whose distance from a place is closest to ``distance``, with the difference as ``gap``."""
    away = F.sqrt((F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y))
    return points.withColumn("gap", F.round(F.abs(away - distance), digits)).orderBy("gap", tie).limit(n)


def last_results(matches: DataFrame, opponent: str, order: str, same_race: Column, won: str) -> DataFrame:
    """Per opponent the last game, the last one of the same race, and whether the last one was won."""
    return matches.groupBy(opponent).agg(
        F.max(order).alias("last_game"), F.max(F.when(same_race, F.col(order))).alias("last_same_race"), F.max_by(won, order).alias("last_won"))


def game_records(rows: DataFrame, game: Sequence[str], duration: Column, context: Column) -> DataFrame:
    """Per game its length, the records it has, and those that carry context."""
    return rows.groupBy(*game).agg(F.max(duration).alias("duration"), F.count(F.lit(1)).alias("records"), F.count_if(context).alias("with_context"))


def result_of(won: Column, duration: Column, tie_below: float) -> Column:
    """1 for a win, 0 for a game too short to count, -1 for a loss."""
    return F.when(won, 1).when(duration < tie_below, 0).otherwise(-1)
