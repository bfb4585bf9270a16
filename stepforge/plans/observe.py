"""Snapshot of a game as a nested struct and its eight text sections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepforge.functions.text import counts_text, queues_text


def snapshot(*, time: Column, minerals: Column, vespene: Column, mineral_rate: Column, gas_rate: Column,
             supply_used: Column, supply_cap: Column, workers: Column, ideal: Column, army: Column, completed: Column,
             building: Column, en_route: Column, queues: Column, enemy: Column, bases: Column, advantages: Column,
             own_power: Column, enemy_power: Column, losses: Column, upgrades: Column, rush: Column, macro: Column,
             proxy: Column, cloak: Column) -> Column:
    """``bases``: own, enemy, neutral; ``advantages``: army, income, predicted;
    ``losses``: own minerals and gas, enemy minerals and gas."""
    economy = F.struct(minerals.alias("minerals"), vespene.alias("vespene"), mineral_rate.alias("minerals_per_min"),
                       gas_rate.alias("vespene_per_min"), supply_used.alias("supply_used"), supply_cap.alias("supply_cap"),
                       workers.alias("supply_workers"), ideal.alias("ideal_worker_count"), army.alias("supply_army"))
    own = F.struct(completed.alias("completed"), building.alias("under_construction"),
                   en_route.alias("workers_en_route"), queues.alias("active_queues"))
    names = ["own_lost_minerals", "own_lost_gas", "enemy_lost_minerals", "enemy_lost_gas"]
    combat = F.struct(
        advantages[0].alias("army_advantage"), advantages[1].alias("income_advantage"),
        advantages[2].alias("advantage_predicted"), own_power.alias("our_army_power"),
        enemy_power.alias("enemy_army_power"), *[losses[i].alias(n) for i, n in enumerate(names)])
    places = ["own_bases", "known_enemy_bases", "neutral_expansions"]
    flags = F.struct(rush.alias("rush_build"), macro.alias("macro_build"), proxy.alias("has_proxy_buildings"),
                     cloak.alias("enemy_cloak_threat"))
    return F.struct(time.alias("time"), economy.alias("economy"), own.alias("own_forces"), enemy.alias("enemy"),
                    F.struct(*[bases[i].alias(n) for i, n in enumerate(places)]).alias("map_control"),
                    combat.alias("combat"), upgrades.alias("upgrades"), flags.alias("memory_flags"))


def render_observation(s: Column) -> Column:
    eco, own, combat, flags = s["economy"], s["own_forces"], s["combat"], s["memory_flags"]

    def whole(c):
        return F.bround(c.cast("double"), 0).cast("bigint")

    minutes, seconds = F.floor(s["time"] / 60), F.floor(s["time"] % 60)
    threats = F.concat_ws(
        "; ", F.when(flags["rush_build"].isNotNull(), F.format_string("enemy rush detected (%s)", flags["rush_build"])),
        F.when(flags["macro_build"] != "StandardMacro", F.format_string("enemy macro build = %s", flags["macro_build"])),
        F.when(flags["has_proxy_buildings"], F.lit("proxy buildings spotted near base")),
        F.when(flags["enemy_cloak_threat"], F.lit("enemy cloak/burrow threat detected")))
    upgrades = F.when(F.size(s["upgrades"]) > 0, F.concat_ws(", ", s["upgrades"])).otherwise("none")
    return F.concat_ws(
        "\n",
        F.format_string("[Time] %d:%02d (%.1fs).", minutes, seconds, s["time"]),
        F.format_string(
            "[Economy] %d minerals, %d vespene; income %d mins/min, %d gas/min. Supply: %d/%d (workers %d/%d "
            "current/ideal, army %d).", eco["minerals"], eco["vespene"], whole(eco["minerals_per_min"]),
            whole(eco["vespene_per_min"]), eco["supply_used"], eco["supply_cap"], eco["supply_workers"],
            eco["ideal_worker_count"], eco["supply_army"]),
        F.lit("[Own Forces & Infrastructure]"),
        F.concat(F.lit("  Completed: "), counts_text(own["completed"], "nothing built yet"), F.lit(".")),
        F.concat(F.lit("  Under Construction: "), counts_text(own["under_construction"], "none"), F.lit(".")),
        F.concat(F.lit("  Workers En Route: "), counts_text(own["workers_en_route"], "none"), F.lit(".")),
        F.concat(F.lit("  Active Queues: "), queues_text(own["active_queues"]), F.lit(".")),
        F.concat(F.lit("[Enemy Intelligence] "), counts_text(s["enemy"], "nothing scouted yet"), F.lit(".")),
        F.format_string("[Map Control] %d own bases, %d known enemy bases, %d neutral expansions remaining.",
                        s["map_control"]["own_bases"], s["map_control"]["known_enemy_bases"],
                        s["map_control"]["neutral_expansions"]),
        F.format_string(
            "[Combat Analysis] army advantage = %s, income advantage = %s, predicted = %s. Power: %d vs %d. Losses: own "
            "%d minerals/%d gas, enemy %d minerals/%d gas.", combat["army_advantage"], combat["income_advantage"],
            combat["advantage_predicted"], whole(combat["our_army_power"]), whole(combat["enemy_army_power"]),
            combat["own_lost_minerals"], combat["own_lost_gas"], combat["enemy_lost_minerals"], combat["enemy_lost_gas"]),
        F.concat(F.lit("[Research & Technology] "), upgrades, F.lit(".")),
        F.concat(F.lit("[Threat Flags] "), F.when(threats == "", "none").otherwise(threats), F.lit(".")))
