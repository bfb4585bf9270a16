"""Predicates and small projections on trajectories, units and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.operators.actions import literal_map

# Target kinds that make an action a macro action, in order of preference.
SEMANTIC_KINDS = ["Build", "BuildOnUnit", "BuildInstant", "Train", "Research", "Morph"]
# Morphs that are recorded.
RECORDED_MORPHS = ["UPGRADETOORBITAL_ORBITALCOMMAND", "UPGRADETOPLANETARYFORTRESS_PLANETARYFORTRESS"]
# Hosts of generic add-on abilities.
ADDON_HOST_SUFFIX = {"BARRACKS": "BARRACKS", "BARRACKSFLYING": "BARRACKS", "FACTORY": "FACTORY",
                     "FACTORYFLYING": "FACTORY", "STARPORT": "STARPORT", "STARPORTFLYING": "STARPORT"}
GENERIC_ADDONS = ["BUILD_TECHLAB", "BUILD_REACTOR"]
# Fields that are not carried into annotated records.
DROPPED_FIELDS = ["answer", "cot", "raw_content", "llm_error", "is_reasoning", "reasoning_source",
                  "reasoning_extract_mode", "prompt"]


def victories(rows: DataFrame, result: Column, complete: Column, on: bool = True) -> DataFrame:
    """Won games with recorded actions; the win test can be switched off."""
    return rows.filter(complete & (result if on else F.lit(True)))


def on_map(rows: DataFrame, map_name: Column, path: Column, wanted: str) -> DataFrame:
    return rows.filter((map_name == wanted) | F.array_contains(F.split(path, "/"), wanted))


def recordable(kind: Column, action: Column) -> Column:
    return kind.isin(*SEMANTIC_KINDS) & ((kind != "Morph") | action.isin(*RECORDED_MORPHS))


def semantic_target(rows: DataFrame, ability: DataFrame, generic: Mapping[str, str]) -> DataFrame:
    """Add kind and target: from the graph, else by the generic's representative, else a research name."""
    known = ability.filter(F.col("kind").isin(*SEMANTIC_KINDS)).select("ability", "kind", F.col("result").alias("target"))
    stand_in = rows.withColumn("_rep", literal_map(dict(generic))[F.col("ability")])
    first = stand_in.join(known, "ability", "left")
    second = known.select(F.col("ability").alias("_rep"), F.col("kind").alias("_kind"), F.col("target").alias("_target"))
    prefix = F.col("ability").startswith("RESEARCH_")
    named = F.substring("ability", F.lit(len("RESEARCH_") + 1), F.length("ability"))
    return first.join(second, "_rep", "left").withColumn(
        "target", F.when(F.col("kind").isNotNull(), F.col("target")).when(F.col("_kind").isNotNull(), F.col("_target"))
        .when(prefix, named)).withColumn(
        "kind", F.coalesce("kind", "_kind", F.when(prefix, F.lit("Research")))).drop("_rep", "_kind", "_target")


def host_action(action: Column, host: Column) -> Column:
    """Generic add-on ability with its host's suffix, else unchanged."""
    suffix = literal_map(ADDON_HOST_SUFFIX)[host]
    return F.when(action.isin(*GENERIC_ADDONS) & suffix.isNotNull(), F.concat_ws("_", action, suffix)).otherwise(action)


def first_text(*texts: Column) -> Column:
    """First non-empty text, else empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def in_range(total: Column, least: int | None, most: int | None) -> Column:
    keep = F.lit(True)
    if least is not None:
        keep = keep & (total >= least)
    if most is not None:
        keep = keep & (total <= most)
    return keep


# Boolean state of units, by the name of the filter.
UNIT_STATES = {
    "ready": lambda: F.col("progress") >= 1,
    "not_ready": lambda: F.col("progress") < 1,
    "idle": lambda: F.col("orders") == 0,
    "owned": lambda: F.col("mine"),
    "enemy": lambda: ~F.col("mine"),
    "flying": lambda: F.col("flying"),
    "not_flying": lambda: ~F.col("flying"),
    "structure": lambda: F.col("structure"),
    "not_structure": lambda: ~F.col("structure"),
    "gathering": lambda: F.col("activity") == "gathering",
    "returning": lambda: F.col("activity") == "returning",
    "collecting": lambda: F.col("activity").isin("gathering", "returning"),
    "visible": lambda: F.col("display") == "visible",
    "mineral_field": lambda: F.col("resource") == "mineral",
    "vespene_geyser": lambda: F.col("resource") == "vespene",
    "selected": lambda: F.col("selected"),
}


def state_filter(units: DataFrame, *states: str) -> DataFrame:
    """Units for which every named state holds."""
    for state in states:
        units = units.filter(UNIT_STATES[state]())
    return units


def of_alias(units: DataFrame, wanted: Sequence[str], aliases: DataFrame, both: bool) -> DataFrame:
    """Units of the wanted types or their aliases; ``both`` also follows aliases of the unit's own type.

    ``aliases`` has type and alias.
    """
    spark = units.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in wanted])).alias("type"))
    wider = names.unionByName(names.join(aliases, "type").select(F.col("alias").alias("type"))).distinct()
    direct = units.join(wider, "type", "left_semi")
    if not both:
        return direct
    own = aliases.join(wider.withColumnRenamed("type", "alias"), "alias", "left_semi").select("type").distinct()
    return units.join(wider.unionByName(own).distinct(), "type", "left_semi")
