"""Trajectories as steps: cutting, cues, summaries and running build state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.functions.vocabulary import (
    BOUNDARY_ACTIONS, GAS_HEAVY_ACTIONS, PRODUCTION_ACTIONS, STICKY_ACTIONS, TRAIN_PREFIXES, WORKER_ACTIONS,
)
from stepforge.operators.chains import BLOCK_ROWS, follow
from stepforge.operators.ordered import blocked_window

# Order in which categories are listed.
CATEGORIES = ["Build", "Train", "Addon", "Research", "Morph", "Other"]


def category(action: Column, structure: Column, addon: Column, kind: Column) -> Column:
    return (F.when(action.startswith("UPGRADETO"), "Morph").when(structure, "Build").when(addon, "Addon")
            .when(kind == "Unit", "Train").when(kind == "Upgrade", "Research").otherwise("Other"))


def category_lines(rows: DataFrame, keys: Sequence[str], product: str, order: str = "seq") -> DataFrame:
    """``[Category] product: xN`` lines, by category and then first appearance."""
    named = rows.withColumn("_cat", category(F.col("ability"), F.col("is_structure"), F.col("is_addon"), F.col("type")))
    counted = named.groupBy(*keys, "_cat", product).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    rank = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("_cat"))
    line = F.concat(F.lit("  ["), "_cat", F.lit("] "), product, F.lit(": x"), F.col("_n").cast("string"))
    entry = F.struct(rank.alias("rank"), F.col("_first").alias("first"), line.alias("line"))
    lists = counted.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    return lists.select(*keys, F.concat_ws("\n", F.transform("_l", lambda e: e["line"])).alias("lines"))


def cumulative_build(rows: DataFrame, traj: str, order: Sequence[str], block: Column,
                     base_workers: int = 12) -> DataFrame:
    """Running count of each product, and workers on top of the starting ones."""
    workers = (F.col("product") == "SCV").cast("bigint")
    out = blocked_window(rows, [traj], order, block, sums={"_workers": workers})
    out = blocked_window(out, [traj, "product"], order, block, number="_made")
    return out.withColumn("so_far", F.col("_made") + 1).withColumn("workers", F.col("_workers") + base_workers).drop(
        "_made", "_workers")


def build_summary(rows: DataFrame, traj: str, time: str, base_workers: int = 12) -> DataFrame:
    """Text of structures, units, workers and upgrades made so far."""
    building = F.col("is_structure") | F.col("is_addon")
    group = F.when(F.col("type") == "Upgrade", "upgrade").when(building, "building").otherwise("unit")
    counted = rows.withColumn("_g", group).groupBy(traj, "_g", "result").agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("first"))
    counted = counted.withColumn("_nth", F.when(F.col("_g") == "upgrade", F.col("first")).otherwise(F.lit(0)))

    def listed(name):
        entry = F.when(F.col("_g") == name, F.struct("_nth", "result", "n"))
        return F.array_sort(F.collect_list(entry))

    lists = counted.groupBy(traj).agg(
        listed("building").alias("b"), listed("unit").alias("u"), listed("upgrade").alias("g"),
        F.coalesce(F.sum(F.when(F.col("result") == "SCV", F.col("n"))), F.lit(0)).alias("w"))

    def text(head, column, line):
        return F.when(F.size(column) > 0, F.concat(F.lit(head), F.concat_ws(", ", F.transform(column, line))))

    times = lambda e: F.concat(e["n"].cast("string"), F.lit("x "), e["result"])
    once = lambda e: F.when(e["n"] == 1, F.concat(F.lit("1st "), e["result"])).otherwise(times(e))
    return lists.select(traj, F.concat_ws(
        "\n", text("Structures: ", "b", once), text("Units: ", "u", times),
        F.concat(F.lit("SCV count: "), (F.col("w") + base_workers).cast("string")),
        text("Upgrades done: ", "g", lambda e: e["result"])).alias("summary"))


MIN_STEP, MAX_STEP, TAIL = 10, 15, 3


def boundary_scores(rows: DataFrame, traj: str = "traj_id", seq: str = "seq", action: str = "ability") -> DataFrame:
    """Add ``score`` of starting a step at each position.

    Position 0 scores -1 and does not count as seen, so the first appearance
    of an action is its first one after position 0.
    """
    boundary, sticky = F.col(action).isin(*BOUNDARY_ACTIONS), F.col(action).isin(*STICKY_ACTIONS)
    first = rows.filter(boundary & (F.col(seq) > 0)).groupBy(traj, action).agg(F.min(seq).alias("_first"))
    score = (F.when(F.col(seq) == 0, -1.0).when(sticky, -0.5)
             .when(boundary & (F.col(seq) == F.col("_first")), 1.0).when(boundary, 0.8).otherwise(0.2))
    return rows.join(first, [traj, action], "left").withColumn("score", score).drop("_first")


def split_steps(scored: DataFrame, traj: str = "traj_id", size: int = BLOCK_ROWS) -> DataFrame:
    """Steps (traj, step_id, start, end) of trajectories with dense ``seq`` and ``score``.

    Every position knows the cut that would follow it, at most ``MAX_STEP``
    ahead, or the end where no whole step would be left; the cuts are those
    reached from position 0. Blocks are counted in positions, so none holds more
    than ``size`` rows and the few that it looks ahead at.
    """
    here, reach = F.floor(F.col("seq") / size), MAX_STEP + TAIL
    seen_by = F.when((F.col("seq") % size < reach) & (here > 0), F.array(here, here - 1)).otherwise(F.array(here))
    rows = scored.select(traj, "seq", "score", F.explode(seen_by).alias("_block"))
    block = Window.partitionBy(traj, "_block")
    ahead = block.orderBy("seq")
    best = F.max_by("seq", F.struct("score", -F.col("seq"))).over(ahead.rowsBetween(MIN_STEP, MAX_STEP))
    # Where no row lies a longest step and its tail ahead, the block sees the trajectory's last row.
    jumps = rows.select(traj, "seq", "_block", best.alias("_best"), F.lead("seq", reach).over(ahead).alias("_far"), F.max("seq").over(block).alias("_last"))
    to = F.when(F.col("_far").isNull(), F.col("_last") + 1).otherwise(F.col("_best"))
    cuts = follow(jumps.filter(F.col("_block") == here).select(traj, "seq", to.alias("to")), [traj], size)
    return cuts.select(traj, F.col("hop").alias("step_id"), F.col("seq").alias("start"), (F.col("to") - 1).alias("end"))


def steps_to_actions(steps: DataFrame, rows: DataFrame, traj: str = "traj_id") -> DataFrame:
    """Rows of a trajectory with the step that covers their ``seq``.

    A step covers few positions, so they are listed and met on (traj, seq): an
    equi join that spreads a long trajectory over its positions.
    """
    covered = steps.select(traj, "step_id", "start", "end", F.explode(F.sequence("start", "end")).alias("seq"))
    return rows.join(covered, [traj, "seq"])


# Cue sentences.
CUES = {
    "worker_saturation": "Worker saturation: phrase SCV production as something to pace from worker current/ideal "
    "together with this step's economy task, such as a new base, orbital, or refinery.",
    "supply_buffer": "Supply buffer: phrase depot planning as depending on current supply headroom plus this step's "
    "SCV, Marine, or production-structure demand, with modest buffer but not excessive unused cap.",
    "gas_refinery": "Gas capacity: describe the Refinery as strengthening gas income or gas flexibility for upcoming "
    "tech, without binding it to one exact unit, upgrade, or building target.",
    "gas_heavy": "Gas capacity: mention minerals and gas as macro capacity for gas-heavy tech, units, or upgrades, "
    "without forcing a one-to-one Refinery target.",
    "macro_pacing": "Macro pacing: keep this step grounded in worker saturation, supply headroom, and minerals/gas "
    "while staying faithful to the listed actions.",
}


def soft_cues(rows: DataFrame, keys: Sequence[str], action: str = "ability") -> DataFrame:
    """Ordered cues of a step from the set of its actions, as plain aggregates."""
    a = F.col(action)
    trained = F.rlike(a, F.lit("^(" + "|".join(TRAIN_PREFIXES) + ")"))
    flags = rows.groupBy(*keys).agg(
        F.bool_or(a.isin(*WORKER_ACTIONS)).alias("_w"),
        (F.bool_or((a == "TERRANBUILD_SUPPLYDEPOT") | a.isin(*PRODUCTION_ACTIONS)) | (F.count_if(trained) >= 4)).alias("_s"),
        F.bool_or(a == "TERRANBUILD_REFINERY").alias("_r"), F.bool_or(a.isin(*GAS_HEAVY_ACTIONS)).alias("_g"))
    cues = F.array_compact(F.array(
        F.when(F.col("_w"), CUES["worker_saturation"]), F.when(F.col("_s"), CUES["supply_buffer"]),
        F.when(F.col("_r"), CUES["gas_refinery"]).when(F.col("_g"), CUES["gas_heavy"])))
    return flags.select(*keys, F.when(F.size(cues) > 0, cues).otherwise(F.array(F.lit(CUES["macro_pacing"]))).alias("cues"))


def ability_facts(ability: DataFrame, accepted: DataFrame, implied: DataFrame, executor: DataFrame) -> DataFrame:
    """One row per known ability: requirements with all that meets them, executors, result.

    An entity that implies an accepted one also meets the requirement, so the
    closure is taken here on the dimension and not again for every state.
    """
    implies = implied.select(F.col("implied").alias("alternative"), "entity")
    wider = accepted.join(implies, "alternative").select("ability", "needs", F.col("entity").alias("alternative"))
    needs = accepted.unionByName(wider).groupBy("ability", "needs").agg(
        F.array_sort(F.collect_set("alternative")).alias("meets"))
    direct = accepted.groupBy("ability", "needs").agg(F.array_sort(F.collect_set("alternative")).alias("accepts"))
    reqs = needs.join(direct, ["ability", "needs"]).groupBy("ability").agg(
        F.array_sort(F.collect_list(F.struct("needs", "accepts", "meets"))).alias("reqs"))
    units = executor.filter(F.col("unit") != "TechLab").groupBy("ability").agg(
        F.array_sort(F.collect_set("unit")).alias("executors"))
    none = F.array().cast("array<string>")
    no_reqs = F.array().cast("array<struct<needs:string,accepts:array<string>,meets:array<string>>>")
    return ability.select("ability", "kind", "result").join(reqs, "ability", "left").join(units, "ability", "left").select(
        "ability", F.struct(F.coalesce("kind", F.lit("")).alias("kind"), "result", F.coalesce("reqs", no_reqs).alias("reqs"),
                            F.coalesce("executors", none).alias("executors")).alias("facts"))


def prereq_replay(steps: DataFrame, keys: Sequence[str], facts: DataFrame, entities: str = "entities") -> DataFrame:
    """Walk a step's actions in order and report what each one lacks.

    ``steps`` has one row per action with ``seq``, ``ability`` and the entities
    at the step's start; a step is short by construction. The state grows only
    when an action was available; a morph uses up its executors.
    """
    known = steps.join(facts, "ability", "left")
    lists = known.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("seq", "ability", "facts"))).alias("acts"),
        F.first(entities).alias("_start"))
    report = "struct<index:int,ability:string,known:boolean,available:boolean,missing:array<string>," \
             "missing_executors:array<string>,order_issue:boolean>"
    none = F.array().cast("array<string>")

    def look(state, act):
        held, f = state["held"], act["facts"]
        index = F.size(state["reports"])
        lacking = F.filter(f["reqs"], lambda r: ~F.arrays_overlap(r["meets"], held))
        no_unit = (F.size(f["executors"]) > 0) & ~F.arrays_overlap(f["executors"], held)
        later = F.slice(F.col("acts"), index + 2, F.size("acts"))
        made_later = F.transform(F.filter(later, lambda x: x["facts"]["result"].isNotNull()), lambda x: x["facts"]["result"])
        issue = F.exists(lacking, lambda r: F.arrays_overlap(r["accepts"], made_later)) | (
            no_unit & F.arrays_overlap(f["executors"], made_later))
        ok = f.isNotNull() & (F.size(lacking) == 0) & ~no_unit
        used = F.when(f["kind"].isin("Morph", "MorphPlace"), F.array_except(held, f["executors"])).otherwise(held)
        grown = F.when(f["result"].isNotNull(), F.array_union(used, F.array(f["result"]))).otherwise(used)
        line = F.struct(
            index.alias("index"), act["ability"].alias("ability"), f.isNotNull().alias("known"),
            F.coalesce(ok, F.lit(False)).alias("available"),
            F.when(f.isNotNull(), F.transform(lacking, lambda r: r["needs"])).otherwise(none).alias("missing"),
            F.when(no_unit, f["executors"]).otherwise(none).alias("missing_executors"),
            F.coalesce(issue, F.lit(False)).alias("order_issue"))
        return F.struct(F.when(ok, grown).otherwise(held).alias("held"),
                        F.concat(state["reports"], F.array(line)).alias("reports"))

    begin = F.struct(F.col("_start").alias("held"), F.array().cast(f"array<{report}>").alias("reports"))
    walked = lists.select(*keys, F.aggregate("acts", begin, look)["reports"].alias("_r"))
    return walked.select(*keys, F.inline("_r"))


def hint_lines(replayed: DataFrame, relations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Text of missing requirements in action order, then of relations between actions."""
    missing = replayed.filter(F.size("missing") > 0).select(
        *keys, F.struct(F.lit(0).alias("part"), F.col("index").alias("at"), F.concat(
            F.lit("  - "), "ability", F.lit(" still missing: "), F.concat_ws(", ", "missing")).alias("line")).alias("e"))
    needed = relations.select(*keys, F.struct(F.lit(1).alias("part"), F.lit(0).alias("at"), F.concat(
        F.lit("  - "), "action", F.lit(" requires "), "depends_on", F.lit(" first (via "), "via", F.lit(")")).alias("line")).alias("e"))
    lists = missing.unionByName(needed).groupBy(*keys).agg(F.array_sort(F.collect_list("e")).alias("e"))
    return lists.select(*keys, F.concat_ws("\n", F.transform("e", lambda e: e["line"])).alias("hints"))


def shuffled(actions: Column, sample: Column, variant: Column, tries: int = 8) -> Column:
    """A seeded order of the actions that differs from the given one if any try does."""
    def attempt(number):
        seed = F.concat_ws(":", sample.cast("string"), variant.cast("string"), F.lit(str(number)))
        keyed = F.transform(actions, lambda a, i: F.struct(
            F.sha2(F.concat(seed, F.lit(":"), i.cast("string")), 256).alias("h"), a.alias("a")))
        return F.transform(F.array_sort(keyed), lambda s: s["a"])

    orders = [attempt(n) for n in range(tries)]
    return F.coalesce(*[F.when(o != actions, o) for o in orders], actions)


def completed_entities(counts: Column, upgrades: Column) -> Column:
    """Sorted entity names: raw names with a positive count, and upgrades."""
    pascal = lambda name: F.regexp_replace(F.initcap(F.regexp_replace(F.lower(name), "[_\\s]+", " ")), " ", "")
    built = F.transform(F.map_keys(F.map_filter(counts, lambda k, v: v > 0)), pascal)
    return F.array_sort(F.array_distinct(F.concat(built, upgrades)))


# Units that exist when a game starts.
STARTING_UNITS = {"SCV": 12, "CommandCenter": 1}


def build_order(rows: DataFrame, game: str, order: Sequence[str], block: Column, frame: str = "frame") -> DataFrame:
    """Build script lines; of neighbours for the same unit only the last is kept.

    ``rows`` has unit (empty for plain actions), kind and action.
    """
    counted = blocked_window(rows, [game, "unit"], order, block, number="_n")
    base = F.create_map(*[F.lit(x) for pair in STARTING_UNITS.items() for x in pair])[F.col("unit")]
    total = F.col("_n") + 1 + F.coalesce(base, F.lit(0))
    line = (F.when(F.col("unit") == "", F.concat(F.lit("# "), "action"))
            .when(F.col("kind") == "Research", F.concat(F.lit("Tech("), "unit", F.lit(")")))
            .otherwise(F.concat(F.lit("BuildId("), "unit", F.lit(", to_count="), total.cast("string"), F.lit(")"))))
    ends = blocked_window(counted.withColumn("line", line), [game], order, block, leads={"_next": F.col("unit")})
    kept = ends.filter(F.col("_next").isNull() | (F.col("unit") == "") | (F.col("_next") != F.col("unit")))
    return kept.withColumn("seconds", F.floor(F.col(frame) / 22.4))


def predict_composition(games: DataFrame, keys: Sequence[str], rules: DataFrame) -> DataFrame:
    """Spend what is left on the units that the seen structures allow, rule by rule.

    ``games`` has race, structures (array), minerals, gas; ``rules`` has race,
    rank, structure (null = always), unit, most, minerals, gas and is a short
    fixed list, so a game's rules fit one row.
    """
    rule = F.struct("rank", "structure", "unit", "most", F.col("minerals").alias("m"), F.col("gas").alias("g"))
    lists = rules.groupBy("race").agg(F.array_sort(F.collect_list(rule)).alias("_rules"))
    pick = "array<struct<rank:int,unit:string,count:bigint>>"
    begin = F.struct(F.col("minerals").cast("double").alias("m"), F.col("gas").cast("double").alias("g"),
                     F.array().cast(pick).alias("picks"))

    def spend(state, r):
        allowed = r["structure"].isNull() | F.array_contains(F.col("structures"), r["structure"])
        # A free resource allows a hundred units.
        per_gas = F.when(r["g"] > 0, state["g"] / r["g"]).otherwise(F.lit(100.0))
        per_minerals = F.when(r["m"] > 0, state["m"] / r["m"]).otherwise(F.lit(100.0))
        most = F.floor(F.least(r["most"].cast("double"), per_minerals, per_gas))
        count = F.when(allowed, F.greatest(F.lit(0).cast("bigint"), most)).otherwise(F.lit(0).cast("bigint"))
        added = F.struct(r["rank"].cast("int").alias("rank"), r["unit"].alias("unit"), count.alias("count"))
        return F.struct((state["m"] - count * r["m"]).alias("m"), (state["g"] - count * r["g"]).alias("g"),
                        F.when(allowed, F.concat(state["picks"], F.array(added))).otherwise(state["picks"]).alias("picks"))

    rows = games.join(lists, "race")
    return rows.select(*keys, F.inline(F.aggregate("_rules", begin, spend)["picks"]))
