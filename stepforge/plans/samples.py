"""Training samples built from steps; what was dropped is a status, not a counter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.plans.steps import shuffled


def naming_samples(steps: DataFrame, items: DataFrame, keys: Sequence[str], system: Column, user: Column) -> DataFrame:
    """One sample per step; a step without items is dropped."""
    rows = steps.join(items, list(keys), "left")
    empty = F.coalesce(F.size("items"), F.lit(0)) <= 0
    sample = X.sharegpt(system, user, X.items_json(F.col("items")), F.lit(""))
    return rows.withColumn("status", F.when(empty, "dropped_empty_answer").otherwise("kept")).withColumn("sample", sample)


def ordering_samples(lists: DataFrame, sample_id: Column, variants: int) -> DataFrame:
    """Shuffled variants of each step's actions with their status.

    A step with fewer than two actions has one row, outside the total.
    """
    short = F.size("actions") < 2
    rows = lists.withColumn("variant", F.explode(F.when(short, F.array(F.lit(None).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.lit(variants - 1)))))
    rows = rows.withColumn("shuffled", shuffled(F.col("actions"), sample_id, F.col("variant")))
    status = (F.when(F.col("variant").isNull(), "dropped_short")
              .when(F.col("shuffled") == F.col("actions"), "dropped_shuffle_same")
              .when(F.array_sort("shuffled") != F.array_sort("actions"), "dropped_counter_mismatch").otherwise("kept"))
    return rows.withColumn("status", status).withColumn("answer", X.actions_json(F.col("actions")))


def executor_status(contexts: DataFrame, modulus: int) -> DataFrame:
    """Status per action with candidates.

    ``contexts`` has file, seq, ability, place, has_context, tags (array) and
    selected. Of equal (file, seq, ability) the first accepted one stays; the
    others count in the total but in no drop counter.
    """
    aliases = F.transform("tags", lambda t: t % modulus)
    status = (F.when(~F.col("has_context"), "dropped_no_context").when(F.size("tags") <= 1, "dropped_single_candidate")
              .when(~F.array_contains("tags", F.col("selected")), "dropped_bad_selected_tag")
              .when(F.size(F.array_distinct(aliases)) < F.size("tags"), "dropped_tag_alias_collision"))
    rows = contexts.withColumn("_status", status)
    key = ["file", "seq", "ability"]
    first = rows.filter(F.col("_status").isNull()).groupBy(*key).agg(F.min("place").alias("_first"))
    kept = F.when(F.col("place") == F.col("_first"), "kept").otherwise("duplicate")
    return rows.join(first, key, "left").withColumn("status", F.coalesce("_status", kept)).withColumn(
        "answer", F.col("selected") % modulus).drop("_status", "_first")


def builder_qa(rows: DataFrame, outside: Sequence[str]) -> DataFrame:
    """Rows per status, and whether the status counts in the total."""
    counted = rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("in_total", ~F.col("status").isin(*outside))


def conflict_hints(contexts: DataFrame, executor: DataFrame, key: str) -> DataFrame:
    """Distinct later actions that one of the candidate types could also execute, in order.

    ``contexts`` has types (entity names) and remaining (ordered actions).
    """
    able = executor.groupBy("ability").agg(F.collect_set("unit").alias("_units"))
    later = contexts.select(key, "types", F.posexplode(F.array_distinct("remaining")).alias("at", "ability"))
    hits = later.join(able, "ability").filter(F.arrays_overlap("types", "_units"))
    lists = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "ability"))).alias("l"))
    return lists.select(key, F.concat_ws("\n", F.transform("l", lambda e: F.concat(F.lit("  - "), e["ability"]))).alias("hints"))
