"""Edges of the tech graph derived from its tables, and checks on edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAKING = ["Build", "BuildOnUnit", "BuildInstant", "Train", "Research"]


def _edge(df: DataFrame, subject: str, relation, object_: str, *extra: str) -> DataFrame:
    return df.select(F.col(subject).alias("subject"), relation.alias("relation"), F.col(object_).alias("object"), *extra)


def has_ability(executor: DataFrame) -> DataFrame:
    return _edge(executor, "unit", F.lit("has_ability"), "ability")


def requires(ability: DataFrame, entity: DataFrame) -> DataFrame:
    kinds = entity.select(F.col("name").alias("needs"), "type")
    rows = ability.filter(F.col("needs").isNotNull()).join(kinds, "needs", "left")
    what = F.when(F.col("type") == "Upgrade", "upgrade").otherwise("unit")
    return _edge(rows, "ability", F.concat(F.lit("ability_requires_"), what), "needs")


def produces(executor: DataFrame, ability: DataFrame) -> DataFrame:
    rows = executor.join(ability.filter(F.col("kind").isin(*MAKING)), "ability")
    relation = F.when(F.col("kind") == "Research", "researches").otherwise("produces")
    return _edge(rows, "unit", relation, "result", "ability")


def unlocks(ability: DataFrame) -> DataFrame:
    return _edge(ability.filter(F.col("needs").isNotNull()), "needs", F.lit("unlocks"), "ability")


def morph_spawn(executor: DataFrame, ability: DataFrame) -> DataFrame:
    rows = executor.join(ability.filter(F.col("kind").isin("Morph", "MorphPlace", "Train")), "ability")
    relation = F.when(F.col("kind") == "Train", "spawns").otherwise("morphs_to")
    return _edge(rows, "unit", relation, "result", "ability")


def action_result(ability: DataFrame) -> DataFrame:
    return _edge(ability.filter(F.col("result").isNotNull()), "ability", F.lit("action_result"), "result")


def violations(edges: DataFrame, allowed: Sequence[tuple[str, str]], attributes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Edges whose subject kind is not allowed for the relation, attribute objects excepted."""
    fits = F.lit(False)
    for relation, kind in allowed:
        fits = fits | ((F.col("relation") == relation) & (F.col("subject_kind") == kind))
    for relation, objects in attributes.items():
        fits = fits | ((F.col("relation") == relation) & F.col("object_kind").isin(*objects))
    return edges.filter(~fits)


def dedupe_edges(edges: DataFrame, subjects: DataFrame, objects: DataFrame) -> DataFrame:
    """Distinct edges whose both ends exist."""
    return edges.dropDuplicates().join(subjects, "subject", "left_semi").join(objects, "object", "left_semi")


def coverage(entities: DataFrame, kind: str) -> DataFrame:
    """Entities with chain, description and relations per kind and overall."""
    return entities.rollup(kind).agg(
        F.count(F.lit(1)).alias("entities"), F.count_if("chain").alias("with_chain"),
        F.count_if("description").alias("with_description"), F.count_if("relations").alias("with_relations"))
