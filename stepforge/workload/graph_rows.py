"""A small tech graph: the dimension tables that actions are joined to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Ability, target kind, result, required entity, action that makes it.
ABILITY_COLUMNS = ["ability", "kind", "result", "needs", "needs_action"]
ABILITIES = [
    ("COMMANDCENTERTRAIN_SCV", "Train", "SCV", None, None),
    ("TERRANBUILD_SUPPLYDEPOT", "Build", "SupplyDepot", None, None),
    ("TERRANBUILD_REFINERY", "BuildOnUnit", "Refinery", None, None),
    ("TERRANBUILD_BARRACKS", "Build", "Barracks", "SupplyDepot", "TERRANBUILD_SUPPLYDEPOT"),
    ("TERRANBUILD_COMMANDCENTER", "Build", "CommandCenter", None, None),
    ("TERRANBUILD_FACTORY", "Build", "Factory", "Barracks", "TERRANBUILD_BARRACKS"),
    ("TERRANBUILD_STARPORT", "Build", "Starport", "Factory", "TERRANBUILD_FACTORY"),
    ("TERRANBUILD_ENGINEERINGBAY", "Build", "EngineeringBay", "CommandCenter", "TERRANBUILD_COMMANDCENTER"),
    ("TERRANBUILD_ARMORY", "Build", "Armory", "Factory", "TERRANBUILD_FACTORY"),
    ("BARRACKSTRAIN_MARINE", "Train", "Marine", "Barracks", "TERRANBUILD_BARRACKS"),
    ("BARRACKSTRAIN_MARAUDER", "Train", "Marauder", "TechLab", None),
    ("FACTORYTRAIN_HELLION", "Train", "Hellion", "Factory", "TERRANBUILD_FACTORY"),
    ("FACTORYTRAIN_SIEGETANK", "Train", "SiegeTank", "TechLab", None),
    ("STARPORTTRAIN_MEDIVAC", "Train", "Medivac", "Starport", "TERRANBUILD_STARPORT"),
    ("STARPORTTRAIN_BANSHEE", "Train", "Banshee", "TechLab", None),
    ("BUILD_TECHLAB_BARRACKS", "BuildInstant", "BarracksTechLab", "Barracks", "TERRANBUILD_BARRACKS"),
    ("BUILD_REACTOR_BARRACKS", "BuildInstant", "BarracksReactor", "Barracks", "TERRANBUILD_BARRACKS"),
    ("BUILD_TECHLAB_FACTORY", "BuildInstant", "FactoryTechLab", "Factory", "TERRANBUILD_FACTORY"),
    ("UPGRADETOORBITAL_ORBITALCOMMAND", "Morph", "OrbitalCommand", "Barracks", "TERRANBUILD_BARRACKS"),
    ("RESEARCH_COMBATSHIELD", "Research", "ShieldWall", "TechLab", None),
    ("BARRACKSTECHLABRESEARCH_STIMPACK", "Research", "Stimpack", "TechLab", None),
    ("MORPH_SUPPLYDEPOT_LOWER", "Morph", "SupplyDepotLowered", None, None),
    ("ATTACK", "Unit", None, None, None),
    ("MOVE_MOVE", None, None, None, None),
]
ACTIONS = [row[0] for row in ABILITIES]

# Unit, its race, an ability it has.
EXECUTOR_COLUMNS = ["ability", "unit", "race"]
EXECUTORS = [
    ("COMMANDCENTERTRAIN_SCV", "CommandCenter", "Terran"),
    ("COMMANDCENTERTRAIN_SCV", "OrbitalCommand", "Terran"),
    ("COMMANDCENTERTRAIN_SCV", "PlanetaryFortress", "Terran"),
    ("TERRANBUILD_SUPPLYDEPOT", "SCV", "Terran"),
    ("TERRANBUILD_REFINERY", "SCV", "Terran"),
    ("TERRANBUILD_BARRACKS", "SCV", "Terran"),
    ("TERRANBUILD_COMMANDCENTER", "SCV", "Terran"),
    ("TERRANBUILD_FACTORY", "SCV", "Terran"),
    ("TERRANBUILD_STARPORT", "SCV", "Terran"),
    ("TERRANBUILD_ENGINEERINGBAY", "SCV", "Terran"),
    ("TERRANBUILD_ARMORY", "SCV", "Terran"),
    ("BARRACKSTRAIN_MARINE", "Barracks", "Terran"),
    ("BARRACKSTRAIN_MARAUDER", "Barracks", "Terran"),
    ("BARRACKSTRAIN_MARAUDER", "BarracksTechLab", "Terran"),
    ("FACTORYTRAIN_HELLION", "Factory", "Terran"),
    ("FACTORYTRAIN_SIEGETANK", "Factory", "Terran"),
    ("FACTORYTRAIN_SIEGETANK", "FactoryTechLab", "Terran"),
    ("STARPORTTRAIN_MEDIVAC", "Starport", "Terran"),
    ("STARPORTTRAIN_BANSHEE", "Starport", "Terran"),
    ("BUILD_TECHLAB_BARRACKS", "Barracks", "Terran"),
    ("BUILD_REACTOR_BARRACKS", "Barracks", "Terran"),
    ("BUILD_TECHLAB_FACTORY", "Factory", "Terran"),
    ("UPGRADETOORBITAL_ORBITALCOMMAND", "CommandCenter", "Terran"),
    ("RESEARCH_COMBATSHIELD", "TechLab", "Terran"),
    ("RESEARCH_COMBATSHIELD", "BarracksTechLab", "Terran"),
    ("BARRACKSTECHLABRESEARCH_STIMPACK", "BarracksTechLab", "Terran"),
    ("MORPH_SUPPLYDEPOT_LOWER", "SupplyDepot", "Terran"),
    ("ATTACK", "Zergling", "Zerg"),
    ("MOVE_MOVE", "Zergling", "Zerg"),
]

# Name, type, race, minerals, gas, supply, build time in frames, flags.
ENTITY_COLUMNS = ["name", "type", "race", "minerals", "gas", "supply", "frames", "is_structure", "is_addon"]
ENTITIES = [
    ("SCV", "Unit", "Terran", 50, 0, 1, 272, False, False),
    ("SupplyDepot", "Unit", "Terran", 100, 0, 0, 480, True, False),
    ("SupplyDepotLowered", "Unit", "Terran", 100, 0, 0, 480, True, False),
    ("Refinery", "Unit", "Terran", 75, 0, 0, 480, True, False),
    ("Barracks", "Unit", "Terran", 150, 0, 0, 1040, True, False),
    ("CommandCenter", "Unit", "Terran", 400, 0, 0, 1600, True, False),
    ("OrbitalCommand", "Unit", "Terran", 550, 0, 0, 560, True, False),
    ("Factory", "Unit", "Terran", 150, 100, 0, 960, True, False),
    ("Starport", "Unit", "Terran", 150, 100, 0, 800, True, False),
    ("EngineeringBay", "Unit", "Terran", 125, 0, 0, 560, True, False),
    ("Armory", "Unit", "Terran", 150, 100, 0, 1040, True, False),
    ("Marine", "Unit", "Terran", 50, 0, 1, 400, False, False),
    ("Marauder", "Unit", "Terran", 100, 25, 2, 480, False, False),
    ("Hellion", "Unit", "Terran", 100, 0, 2, 480, False, False),
    ("SiegeTank", "Unit", "Terran", 150, 125, 3, 720, False, False),
    ("Medivac", "Unit", "Terran", 100, 100, 2, 672, False, False),
    ("Banshee", "Unit", "Terran", 150, 100, 3, 960, False, False),
    ("BarracksTechLab", "Unit", "Terran", 50, 25, 0, 400, False, True),
    ("BarracksReactor", "Unit", "Terran", 50, 50, 0, 800, False, True),
    ("FactoryTechLab", "Unit", "Terran", 50, 25, 0, 400, False, True),
    ("ShieldWall", "Upgrade", "Terran", 100, 100, 0, 1760, False, False),
    ("Stimpack", "Upgrade", "Terran", 100, 100, 0, 2240, False, False),
    ("Zergling", "Unit", "Zerg", 25, 0, 1, 384, False, False),
]

# What a unit of each part type is worth and can do.
UNIT_VALUE_COLUMNS = ["type", "minerals", "gas", "power", "flying", "hits_ground", "shoots_air", "weak_air",
                      "melee", "surround", "siege", "cloak", "detector", "worker"]
UNIT_VALUES = [
    ("ECONOMY", 50, 0, 0.25, False, True, False, False, True, False, False, False, False, True),
    ("STANDARD", 50, 0, 0.5, False, True, True, False, False, False, False, False, False, False),
    ("SMALL", 25, 0, 0.375, False, True, False, False, True, True, False, False, False, False),
    ("MEDIUM", 50, 100, 1.0, False, True, True, True, False, False, False, False, True, False),
    ("LARGE", 150, 125, 3.0, False, True, False, False, False, False, True, False, False, False),
    ("PROMO", 150, 100, 2.5, True, True, True, False, False, False, False, True, False, False),
]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _values(columns: list[str], rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


TABLES = {
    "ability": (ABILITY_COLUMNS, ABILITIES),
    "executor": (EXECUTOR_COLUMNS, EXECUTORS),
    "entity": (ENTITY_COLUMNS, ENTITIES),
    "unit_values": (UNIT_VALUE_COLUMNS, UNIT_VALUES),
}


def graph_sql(name: str) -> str:
    return _values(*TABLES[name])


def values_sql(columns: list[str], rows: list[tuple]) -> str:
    return _values(columns, rows)


def values_frame(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Literal rows whose exact size the optimizer knows, so it may broadcast them."""
    return spark.sql(_values(columns, rows))


def graph(spark: SparkSession, name: str) -> DataFrame:
    return values_frame(spark, *TABLES[name])
