"""Joins of actions to the tech graph.

The graph tables are dimensions whose size does not follow the data; no hint is
given, the optimizer broadcasts them only when their size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.functions.vocabulary import (
    ADDON_HOSTS, CONTROL_PRODUCTS, KIND_RANK, MORPH_TARGETS, QUEUE_KINDS, RESEARCH_HOSTS,
)

PRODUCING_KINDS = ["Build", "BuildOnUnit", "BuildInstant", "Train", "Morph"]


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def action_to_item(df: DataFrame, ability: DataFrame) -> DataFrame:
    """Add ``item``: what a producing or researching action yields, else null."""
    kinds = ability.select("ability", F.when(
        F.col("kind").isin(*PRODUCING_KINDS, "Research"), F.col("result")).alias("item"))
    return df.join(kinds, "ability", "left")


def title_words(text: Column) -> Column:
    """``UPPER_SNAKE`` as ``Upper Snake``, letters after digits capitalised like Python's title."""
    words = F.split(text, "_")
    spaced = F.concat_ws(" ", words)
    # initcap starts words at spaces only; a letter behind a digit or sign also starts one.
    parts = F.regexp_extract_all(spaced, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.when(text.isNotNull(), F.concat_ws("", F.transform(parts, F.initcap)))


def pattern_product(action: Column) -> Column:
    """Product read from the shape of the action's name, most specific shape first."""
    def after(prefix):
        return F.substring(action, F.lit(len(prefix) + 1), F.length(action))

    def extract(pattern, group=1):
        found = F.regexp_extract(action, pattern, group)
        return F.when(F.rlike(action, F.lit(pattern)), found)

    morph_rest = after("MORPH_")
    morph = F.lit(None).cast("string")
    for target in sorted(MORPH_TARGETS, key=len):
        rest = F.regexp_replace(F.substring(morph_rest, F.lit(len(target) + 1), F.length(morph_rest)), "^_", "")
        named = F.lit(target.title())
        text = F.when(rest != "", F.concat(named, F.lit(" ("), title_words(rest), F.lit(" mode)"))).otherwise(named)
        # Longer targets are tested later and so override shorter ones.
        morph = F.when(F.upper(morph_rest).startswith(target), text).otherwise(morph)
    head, mode = F.regexp_extract(morph_rest, "^(.+)_(.+)$", 1), F.regexp_extract(morph_rest, "^(.+)_(.+)$", 2)
    morph = F.coalesce(morph, F.when(head != "", F.concat(
        title_words(head), F.lit(" ("), title_words(mode), F.lit(" mode)"))))

    return F.coalesce(
        F.when(action.startswith("MORPH_"), morph),
        F.when(action.startswith("EFFECT_"), title_words(after("EFFECT_"))),
        F.when(action.startswith("CALLDOWNMULE_"), F.lit("MULE")),
        F.when(action.startswith("SCANNERSWEEP_"), F.lit("ScannerSweep")),
        F.when(action.startswith("KD8CHARGE_"), F.lit("KD8Charge")),
        F.when(action.startswith("HARVEST_"), title_words(after("HARVEST_"))),
        F.when(action.startswith("RALLY_"), F.lit("RallyPoint")),
        F.when(action.startswith("CANCEL_"), F.lit("(Cancel)")),
        title_words(extract("^.+BUILD_(.+)$")),
        title_words(extract("^.*TRAIN_(.+)$")),
        title_words(extract("^UPGRADETO.+_(.+)$")),
        extract("^.*RESEARCH_(.+)$"),
    )


def action_to_product(df: DataFrame, results: DataFrame) -> DataFrame:
    """Add ``product``: graph edge, fixed text, name pattern, else marked unknown."""
    action = F.col("ability")
    fixed = literal_map(CONTROL_PRODUCTS)[action]
    text = F.coalesce(F.col("_result"), fixed, pattern_product(action),
                      F.concat(F.lit("(Unknown: "), action, F.lit(")")))
    return (
        df.join(results.select("ability", F.col("result").alias("_result")), "ability", "left")
        .withColumn("product", F.when(F.coalesce(action, F.lit("")) == "", "(Unknown)").otherwise(text))
        .drop("_result")
    )


def simple_product(action: Column, result: Column) -> Column:
    """Graph result, else the last name part if it is upper case, else a mark."""
    last = F.element_at(F.split(action, "_"), -1)
    usable = action.contains("_") & (F.upper(last) == last)
    return F.coalesce(result, F.when(usable, last), F.lit("(no product)"))


def executor_index(executor: DataFrame, race: str | None = None) -> DataFrame:
    """Ability with the sorted set of units that have it."""
    rows = executor if race is None else executor.filter(F.col("race") == race)
    return rows.groupBy("ability").agg(F.array_sort(F.collect_set("unit")).alias("units"))


def entity_actions(entities: DataFrame, ability: DataFrame, executor: DataFrame) -> DataFrame:
    """Abilities that produce an entity (matched without case) and have an executor."""
    wanted = entities.select("entity", F.lower("entity").alias("_key"))
    made = ability.select("ability", "kind", "result", F.lower("result").alias("_key"))
    units = executor_index(executor).withColumnRenamed("units", "executors")
    return wanted.join(made, "_key").join(units, "ability").drop("_key")


def kind_rank(kind: Column) -> Column:
    return F.coalesce(literal_map({k: str(v) for k, v in KIND_RANK.items()})[kind].cast("int"), F.lit(9))


def primary_action(entity_rows: DataFrame) -> DataFrame:
    """The preferred producing ability per entity."""
    return entity_rows.groupBy("entity").agg(
        F.min(F.struct(kind_rank(F.col("kind")).alias("rank"), "ability"))["ability"].alias("ability"))


def queue_resources(ability: DataFrame, executor: DataFrame, ignore_builders: bool = True) -> DataFrame:
    """Ability with each producer it occupies; only abilities that use a queue."""
    action, kind, unit = F.col("ability"), F.col("kind"), F.col("unit")
    queued = kind.isin(*QUEUE_KINDS) | (action == "BUILD_NUKE") | F.rlike(action, F.lit("^(LIFT_|LAND_)"))
    rows = ability.filter(queued).join(executor.select("ability", "unit"), "ability", "left")
    if ignore_builders:
        rows = rows.filter(~((unit == "SCV") & kind.isin("Build", "BuildOnUnit")) | unit.isNull())
    from_unit = rows.filter(unit.isNotNull() & (unit != "TechLab")).select(
        "ability", F.coalesce(literal_map(ADDON_HOSTS)[unit], unit).alias("resource"))
    from_research = ability.filter(queued).select(
        "ability", literal_map(RESEARCH_HOSTS)[action].alias("resource")).filter(F.col("resource").isNotNull())
    return from_unit.unionByName(from_research).distinct()


def action_conflicts(actions: DataFrame, keys: Sequence[str], resources: DataFrame, order: str) -> DataFrame:
    """Pairs of a step's distinct actions that share a producer.

    Pairs are formed between distinct actions of the vocabulary, found once on
    the graph; a step only looks up which of those pairs it holds.
    """
    left, right = resources.alias("l"), resources.alias("r")
    pairs = (
        left.join(right, F.col("l.resource") == F.col("r.resource"))
        .filter(F.col("l.ability") != F.col("r.ability"))
        .groupBy(F.col("l.ability").alias("a"), F.col("r.ability").alias("b"))
        .agg(F.array_sort(F.collect_set("l.resource")).alias("shared"))
    )
    firsts = actions.groupBy(*keys, "ability").agg(F.min(order).alias("first"))
    one = firsts.select(*keys, F.col("ability").alias("a"), F.col("first").alias("first_a"))
    two = firsts.select(*keys, F.col("ability").alias("b"), F.col("first").alias("first_b"))
    return (
        one.join(pairs, "a").join(two, [*keys, "b"])
        .filter(F.col("first_a") < F.col("first_b"))
        .select(*keys, F.col("a").alias("left_action"), F.col("b").alias("right_action"), "shared")
    )


def accepted_entities(ability: DataFrame, executor: DataFrame) -> DataFrame:
    """(ability, needs, alternative): everything that meets an ability's requirement."""
    required = ability.filter(F.col("needs").isNotNull())
    itself = required.select("ability", "needs", F.col("needs").alias("alternative"))
    made = ability.select(F.col("ability").alias("needs_action"), F.col("result").alias("alternative"))
    results = required.join(made, "needs_action").filter(F.col("alternative").isNotNull()).select(
        "ability", "needs", "alternative")
    labs = required.filter(F.col("needs") == "TechLab").join(executor, "ability").filter(
        F.col("unit").endswith("TechLab") & (F.col("unit") != "TechLab")
    ).select("ability", "needs", F.col("unit").alias("alternative"))
    return itself.unionByName(results).unionByName(labs).distinct()


def step_prereqs(actions: DataFrame, keys: Sequence[str], ability: DataFrame, executor: DataFrame) -> DataFrame:
    """Relations inside a step: an action depends on another that makes what it needs."""
    made = ability.select(F.col("ability").alias("depends_on"), F.col("result").alias("via"))
    relations = accepted_entities(ability, executor).select("ability", F.col("alternative").alias("via")).join(
        made, "via").filter(F.col("ability") != F.col("depends_on")).distinct()
    present = actions.select(*keys, "ability").distinct()
    others = present.select(*keys, F.col("ability").alias("depends_on"))
    return present.join(relations, "ability").join(others, [*keys, "depends_on"]).select(
        *keys, F.col("ability").alias("action"), "depends_on", "via")


def gap_fill(rows: DataFrame, ability: DataFrame, executor: DataFrame, key: str) -> DataFrame:
    """Actions to insert for what is missing and not already coming, distinct in order.

    ``rows`` has facts (see ``ability_facts``), held and coming entities.
    """
    lacking = F.transform(F.filter("facts.reqs", lambda r: ~F.arrays_overlap(r["meets"], F.col("held"))),
                          lambda r: r["needs"])
    units = F.col("facts.executors")
    nobody = F.when((F.size(units) > 0) & ~F.arrays_overlap(units, F.col("held")), units).otherwise(
        F.array().cast("array<string>"))
    missing = F.array_distinct(F.concat(lacking, nobody))
    wanted = rows.select(key, "coming", F.posexplode(missing).alias("at", "entity"))
    wanted = wanted.filter(~F.array_contains("coming", F.col("entity")))
    able = ability.filter(F.col("result").isNotNull()).join(executor.select("ability").distinct(), "ability", "left_semi")
    plain = F.when(F.rlike("kind", F.lit("^(Build|Train|Research)")), 0).otherwise(1)
    best = able.groupBy(F.col("result").alias("entity")).agg(
        F.min(F.struct(plain.alias("rank"), "ability"))["ability"].alias("fill"))
    fills = wanted.join(best, "entity").groupBy(key, "fill").agg(F.min("at").alias("at"))
    lists = fills.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "fill"))).alias("f"))
    return lists.select(key, F.transform("f", lambda e: e["fill"]).alias("fills"))


def action_table(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Fixed-width lines of action, product, type, cost and requirement.

    The action column is as wide as the longest name of the graph.
    """
    # The graph is a small dimension, so one window over all of it is cheap.
    sized = facts.withColumn("_w", F.max(F.length("ability")).over(Window.partitionBy()))
    minerals, gas = F.coalesce("minerals", F.lit(0)), F.coalesce("gas", F.lit(0))
    cost = F.when(minerals + gas > 0, F.concat_ws("/", minerals.cast("string"), gas.cast("string"))).otherwise("-")
    product = simple_product(F.col("ability"), F.col("result"))
    line = F.concat(F.rpad("ability", F.col("_w"), F.lit(" ")), F.lit("  "), F.rpad(product, 28, " "), F.lit(" "),
                    F.rpad(F.coalesce("type", F.lit("-")), 8, " "), F.lit(" "), F.lpad(cost, 14, " "), F.lit(" "),
                    F.rpad(F.coalesce("requires", F.lit("-")), 20, " "))
    return rows.join(sized.select("ability", line.alias("line")), "ability")


def train_candidates(actions: DataFrame, producers: DataFrame, trainers: DataFrame, keys: Sequence[str], action: str = "action") -> DataFrame:
    """The producers that a Train action could have gone to, a row each, where there is more than one.

    ``actions`` has the action's id, ``keys`` (its game), ability and kind;
    ``producers`` keys, tag, unit and progress, where a tag may repeat; ``trainers``
    ability and unit. Unfinished producers do not count. Producers per game and
    type are counted first, so actions with one candidate are joined to none.
    """
    keys = list(keys)
    ready = producers.groupBy(*keys, "tag").agg(F.min_by("unit", "unit").alias("unit"), F.max("progress").alias("_p")).filter("_p >= 1").drop("_p")
    sizes = ready.groupBy(*keys, "unit").agg(F.count(F.lit(1)).alias("_n"))
    asked = actions.filter(F.col("kind") == "Train").select(action, *keys, "ability").join(trainers.select("ability", "unit").distinct(), "ability")
    counts = asked.join(sizes, [*keys, "unit"]).groupBy(action).agg(F.sum("_n").alias("candidates")).filter("candidates > 1")
    return asked.join(counts, action).join(ready, [*keys, "unit"]).select(action, *keys, "tag", "unit", "candidates")
