"""Power, economy and state of a game computed from tables of units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.operators.ordered import blocked_window
from stepforge.operators.pyramid import Between, build, range_sums

# Gas per second of one saturated miner slot; excess workers mine at half rate.
GAS_RATE = 0.94339622641509433962
EXCESS_RATE = 0.5
WEAK_AIR_POWER = 0.5
CANCEL_SHARE = 0.25

POWER_FIELDS = ["power", "air_presence", "ground_presence", "air_power", "ground_power", "melee_power",
                "surround_power", "siege_power", "stealth_power", "detectors"]


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def strengths(power: Column, air: Column, detectors: Column) -> dict[str, Column]:
    """What a row adds to each of the ten strengths; ``air`` is what it adds against air if it shoots up."""
    def part(condition: Column, value: Column = power) -> Column:
        return F.when(condition, value).otherwise(F.lit(0.0))

    ground = F.col("hits_ground")
    return {"power": power, "air_presence": part(F.col("flying")), "ground_presence": part(~F.col("flying")),
            "air_power": part(F.col("shoots_air"), air), "ground_power": part(ground), "melee_power": part(ground & F.col("melee")),
            "surround_power": part(ground & F.col("surround")), "siege_power": part(F.col("siege")),
            "stealth_power": part(F.col("cloak")), "detectors": F.when(F.col("detector"), detectors).otherwise(0)}


def power_vector(units: DataFrame, keys: Sequence[str], values: DataFrame) -> DataFrame:
    """Ten additive strengths per group; types are counted first.

    Air strength of a weak type is a fixed amount per unit. Siege strength is
    summed like the others.
    """
    per_type = units.groupBy(*keys, "type").agg(F.count(F.lit(1)).alias("_n"))
    power = F.col("power") * F.col("_n")
    air = F.when(F.col("weak_air"), F.col("_n") * WEAK_AIR_POWER).otherwise(power)
    added = strengths(power, air, F.col("_n"))
    return per_type.join(values, "type").groupBy(*keys).agg(*[F.sum(added[f]).alias(f) for f in POWER_FIELDS])


def enough_for(own: str, other: str, share: float) -> Column:
    """Whether the own strength struct, scaled, meets the other in air, on ground and in total."""
    return (F.col(f"{own}.power") >= 1) & (
        (F.col(f"{own}.air_power") * share >= F.col(f"{other}.air_presence"))
        & (F.col(f"{own}.ground_power") * share >= F.col(f"{other}.ground_presence"))
        & (F.col(f"{own}.power") * share >= F.col(f"{other}.power")))


def sides(units: DataFrame, keys: Sequence[str], values: DataFrame) -> DataFrame:
    """One row per group with the strength of each side as structs ``own`` and ``enemy``."""
    # Sums of numbers alone fill one hash table; the greatest struct of a side would sort its rows, and groups are many and small.
    air = F.when(F.col("weak_air"), F.lit(WEAK_AIR_POWER)).otherwise(F.col("power"))
    added = strengths(F.col("power"), air, F.lit(1).cast("bigint"))
    rows = units.filter(F.col("mine").isNotNull()).select(*keys, "mine", "type").join(values, "type")
    side = lambda name, mine: [F.sum(F.when(mine, added[f])).alias(f"_{name}_{f}") for f in POWER_FIELDS]
    summed = rows.groupBy(*keys).agg(*side("own", F.col("mine")), *side("enemy", ~F.col("mine")))
    zero = lambda f: F.lit(0).cast("bigint" if f == "detectors" else "double")
    struct = lambda name: F.struct(*[F.coalesce(f"_{name}_{f}", zero(f)).alias(f) for f in POWER_FIELDS]).alias(name)
    return summed.select(*keys, struct("own"), struct("enemy"))


def zone_states(units: DataFrame, enemies: DataFrame, zones: DataFrame, values: DataFrame, danger_radius: float,
                line_radius: float = 10.0) -> DataFrame:
    """State of every zone: strength of both sides, what assaults it, and whether it is attacked or to be evacuated.

    ``units`` has zone, type, mine of the units assigned to zones; ``enemies``
    has type, x, y of all enemy units; ``zones`` has zone, cx, cy, lx, ly (the
    mineral line's middle), ours, enemys. Enemies assault a zone of ours from
    ``danger_radius`` around its middle, and workers leave it when fighters with
    some strength against ground are near its mineral line. Zones without units
    are judged too.
    """
    own = sides(units, ["zone"], values).select("zone", F.col("own.power").alias("own_power"), F.col("enemy.power").alias("enemy_power"))
    armed = enemies.join(values, "type").select(
        "x", "y", "power", F.when(F.col("hits_ground"), F.col("power")).otherwise(0.0).alias("ground"), (~F.col("worker")).cast("int").alias("fighter"))
    ours = zones.filter("ours")

    def around(radius: float, cx: str, cy: str, wanted: dict[str, str]) -> DataFrame:
        tree = build(armed, radius, {v: F.col(v) for v in wanted.values()})
        reach = Between(high=radius * radius, closed=True)
        return range_sums(tree, ours.select("zone", F.col(cx).alias("cx"), F.col(cy).alias("cy")), ["zone"], {n: (v, reach) for n, v in wanted.items()})

    assault = around(danger_radius, "cx", "cy", {"assault_power": "power"})
    line = around(line_radius, "lx", "ly", {"_ground": "ground", "_fighters": "fighter"})
    joined = zones.select("zone", "ours", "enemys").join(own, "zone", "left").join(assault, "zone", "left").join(line, "zone", "left")
    filled = joined.select("zone", "ours", "enemys", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("own_power", "enemy_power", "assault_power")],
                           (F.coalesce(F.col("_ground") > 3, F.lit(False)) & (F.coalesce("_fighters", F.lit(0)) > 0)).alias("evacuate"))
    balance = F.round(F.col("own_power") - F.col("enemy_power"), 1)
    attacked = (F.col("ours") & (F.col("assault_power") > 5)) | (balance < 1) | (F.col("enemys") & (balance > 0))
    return filled.withColumn("balance", balance).withColumn("under_attack", attacked)


def known_counts(sightings: DataFrame, destroyed: DataFrame, keys: Sequence[str], ignored: Sequence[str]) -> DataFrame:
    """Distinct living tags per type, minus those known to have morphed away.

    ``sightings`` has tag, type, snapshot, hallucination, morphed.
    """
    seen = sightings.filter(~F.col("type").isin(*ignored) & ~F.col("snapshot") & ~F.col("hallucination"))
    tags = seen.groupBy(*keys, "type", "tag").agg(F.max(F.col("morphed").cast("int")).alias("_m"))
    alive = tags.join(destroyed.select(*keys, "tag").distinct(), [*keys, "tag"], "left_anti")
    return alive.groupBy(*keys, "type").agg((F.count(F.lit(1)) - F.sum("_m")).alias("count"))


def known_power(counts: DataFrame, keys: Sequence[str], values: DataFrame, excluded: str) -> DataFrame:
    """Strength of known units without workers and one support type."""
    rows = counts.join(values, "type").filter(~F.col("worker") & (F.col("type") != excluded))
    return rows.groupBy(*keys).agg(F.sum(F.col("power") * F.col("count")).alias("power"))


def income_rate(bases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mineral and gas income per second; ``bases`` has assigned, ideal, gas."""
    a, i = F.col("assigned"), F.col("ideal")
    minerals = F.least(a, i) + F.greatest(a - i, F.lit(0)) * EXCESS_RATE
    return bases.groupBy(*keys).agg(
        F.sum(F.when(~F.col("gas"), minerals).otherwise(0.0)).alias("minerals"),
        (F.sum(F.when(F.col("gas"), F.least(a, i)).otherwise(0)) * GAS_RATE).alias("gas"))


def lost_resources(lost: DataFrame, keys: Sequence[str], values: DataFrame) -> DataFrame:
    """Cost of lost units; a cancelled structure counts a quarter."""
    share = F.when(F.col("cancelled"), CANCEL_SHARE).otherwise(1.0)
    weight = lost.groupBy(*keys, "type").agg(F.sum(share).alias("_w")).join(values, "type")
    return weight.groupBy(*keys).agg(F.sum(F.col("minerals") * F.col("_w")).alias("minerals"),
                                     F.sum(F.col("gas") * F.col("_w")).alias("gas"))


def alive_dead(alive: DataFrame, dead: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units per side and type: total, alive and dead, largest total first."""
    tagged = alive.select(*keys, F.lit(1).alias("_a")).unionByName(dead.select(*keys, F.lit(0).alias("_a")))
    rows = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.sum("_a").alias("alive"))
    return rows.withColumn("dead", F.col("total") - F.col("alive")).orderBy(F.desc("total"), *keys)


def tiered_counts(units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Completed, under construction and queued counts by type, as three maps.

    ``units`` has type, structure, ready, queued.
    """
    tier = (F.when(F.col("ready"), "completed").when(F.col("structure"), "under_construction")
            .otherwise("active_queues"))
    name = F.when(tier == "active_queues", F.concat(F.lit("Training "), "type")).otherwise(F.col("type"))
    rows = units.select(*keys, tier.alias("tier"), name.alias("name"))
    queued = units.filter(F.col("structure") & F.col("ready") & F.col("queued").isNotNull()).select(
        *keys, F.lit("active_queues").alias("tier"), F.concat(F.lit("Training "), "queued").alias("name"))
    counted = rows.unionByName(queued).groupBy(*keys, "tier", "name").agg(F.count(F.lit(1)).alias("n"))

    def as_map(value):
        entries = F.collect_list(F.when(F.col("tier") == value, F.struct("name", "n")))
        return F.map_from_entries(F.array_sort(entries))

    return counted.groupBy(*keys).agg(*[as_map(t).alias(t) for t in ("completed", "under_construction", "active_queues")])


def pending_abilities(units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Orders plus unfinished units by creation ability, with the greatest progress.

    ``units`` has ability (of an order, or null), creation, ready, progress.
    """
    orders = units.filter(F.col("ability").isNotNull()).select(
        *keys, "ability", F.lit(None).cast("double").alias("progress"))
    unfinished = units.filter(~F.col("ready")).select(*keys, F.col("creation").alias("ability"), "progress")
    return orders.unionByName(unfinished).groupBy(*keys, "ability").agg(
        F.count(F.lit(1)).alias("pending"), zero_if_null(F.max("progress")).alias("progress"))


def type_progress(wanted: DataFrame, units: DataFrame, aliases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Greatest build progress over a type and its equivalents, 0 if there is none."""
    best = units.groupBy(*keys, "type").agg(F.max("progress").alias("_p"))
    same = aliases.select(F.col("type").alias("wanted"), F.col("alias").alias("type"))
    every = same.unionByName(wanted.select("wanted", F.col("wanted").alias("type"))).distinct()
    asked = wanted.join(every, "wanted").join(best, [*keys, "type"], "left")
    return asked.groupBy(*keys, "wanted").agg(zero_if_null(F.max("_p")).alias("progress"))


def local_entities(units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted names that are complete and in progress; pending is always empty."""
    def names(condition):
        return F.array_sort(F.collect_set(F.when(condition, F.col("name"))))

    return units.groupBy(*keys).agg(
        names(F.col("progress") >= 1).alias("completed"), names(F.col("progress") < 1).alias("in_progress")
    ).withColumn("pending", F.array().cast("array<string>"))


# Income advantage bands, from the strongest.
INCOME_BANDS = [(40, "Overwhelming"), (20, "Clear"), (10, "Small"), (5, "Slight")]
# Least own strength and share at which an advantage counts as larger.
ARMY_BANDS = [(20, 1 / 3, "Overwhelming"), (10, 1 / 2, "Clear"), (5, 1 / 1.4, "Small")]
AIR_BANDS = [(0.90, "AllAir"), (0.65, "AlmostAllAir"), (0.35, "Mixed"), (0.0, "SomeAir")]


def income_bucket(number: Column) -> Column:
    ladder = F.lit("Even")
    for limit, name in reversed(INCOME_BANDS):
        ladder = (F.when(number > limit, name + "Advantage").when(number < -limit, name + "Disadvantage")
                  .otherwise(ladder))
    return ladder


def army_bucket(own: str = "own", enemy: str = "enemy") -> Column:
    def side(a, b, word):
        ladder = F.lit("Slight" + word)
        for least, share, name in reversed(ARMY_BANDS):
            ladder = F.when((F.col(f"{a}.power") > least) & enough_for(a, b, share), name + word).otherwise(ladder)
        return ladder

    return (F.when(enough_for(own, enemy, 1 / 1.1), side(own, enemy, "Advantage"))
            .when(enough_for(enemy, own, 1 / 1.1), side(enemy, own, "Disadvantage")).otherwise("Even"))


def air_bucket(share: Column) -> Column:
    ladder = F.lit("NoAir")
    for limit, name in reversed(AIR_BANDS):
        ladder = F.when(share > limit, name).otherwise(ladder)
    return ladder


def counted_strength(counts: DataFrame, keys: Sequence[str], values: DataFrame) -> DataFrame:
    """Strength struct ``predicted`` per group of counted types (type, count), such as known and guessed ones merged."""
    rows = counts.filter(F.col("count") > 0).join(values, "type")
    n, power = F.col("count"), F.col("power") * F.col("count")

    def total(condition: Column, value: Column = power) -> Column:
        return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))

    air = F.when(F.col("weak_air"), n * WEAK_AIR_POWER).otherwise(power)
    return rows.groupBy(*keys).agg(
        F.sum(power).alias("power"), total(F.col("flying")).alias("air_presence"), total(~F.col("flying")).alias("ground_presence"),
        total(F.col("shoots_air"), air).alias("air_power"), total(F.col("hits_ground")).alias("ground_power")).select(
        *keys, F.struct("power", "air_presence", "ground_presence", "air_power", "ground_power").alias("predicted"))


def advantage_report(games: DataFrame) -> DataFrame:
    """Buckets and verdicts per game: ``own``, ``enemy`` and ``predicted`` enemy strength, income, zones, workers.

    The known enemy gives ``army_advantage``. Verdicts, ``army_predicted`` and
    the share of air follow the predicted enemy: what can shoot up, over all, if
    anything flies.
    """
    income = income_bucket(F.col("income") + F.col("zones") * 10)
    guess = F.col("predicted")
    air = F.when(guess["air_presence"] > 0, guess["air_power"] / guess["power"]).otherwise(0.0)
    rows = games.withColumn("income_advantage", income).withColumn("army_advantage", army_bucket()).withColumn(
        "army_predicted", army_bucket("own", "predicted")).withColumn("enemy_air", air_bucket(air))
    best, worst = "OverwhelmingAdvantage", "OverwhelmingDisadvantage"
    return rows.withColumn(
        "victory", (F.col("army_predicted") == best) & (F.col("income_advantage") == best)).withColumn(
        "defeat", (F.col("army_predicted") == worst) & (
            (F.col("workers") < 5) | (F.col("income_advantage") == worst)))


def supply_cost(types: DataFrame, producers: DataFrame) -> DataFrame:
    """Supply of a type minus that of what it is made from.

    ``types`` has type, supply, special (a fixed value or null); ``producers``
    has type, used_supply.
    """
    used = producers.groupBy("type").agg(F.max("used_supply").alias("_used"))
    return types.join(used, "type", "left").select(
        "type", F.coalesce("special", F.col("supply") - zero_if_null(F.col("_used"))).alias("cost"))


def affordable(cost: Column, supply_left: Column) -> Column:
    return (cost <= 0) | (cost <= supply_left)


def mineral_total(patches: DataFrame, zone: str, block: Column) -> DataFrame:
    """Minerals of a zone per visit and the stored value, which only falls.

    ``patches`` has visit, visible, contents, type.
    """
    guess = F.when(F.col("type").endswith("750"), 900).otherwise(1800)
    seen = patches.groupBy(zone, "visit").agg(
        F.sum(F.when(F.col("visible"), F.col("contents")).otherwise(guess)).alias("total"))
    kept = blocked_window(seen, [zone], ["visit"], block, minima={"stored": F.col("total")})
    left = F.col("stored")
    band = (F.when(left >= 10000, "Full").when(left >= 5000, "Plenty").when(left >= 1500, "Limited")
            .when(left > 0, "NearEmpty").otherwise("Empty"))
    return kept.withColumn("band", band)


def worker_window(*, before: Column, now: Column, ours: Column, enemys: Column, visible: Column, workers_seen: Column, finished: Column,
                  scouted: Column, build_time: int) -> Column:
    """Until when enemy workers may be in a zone, from what was held ``before``.

    ``finished`` is when the enemy's base is or will be complete, null without a
    base; ``scouted`` when the zone was last seen, null if never.
    """
    held = F.when(ours, now + 300).otherwise(before)
    seen = F.when(enemys & workers_seen, F.lit(0)).when(enemys & finished.isNotNull(), F.greatest(now, finished) + 60).otherwise(held)
    unseen = F.when(scouted.isNull(), F.lit(180)).when(ours | enemys, scouted + build_time + 90).otherwise(held)
    return F.when(visible, seen).otherwise(unseen)


def loss_events(destroyed: DataFrame, values: DataFrame, real_types: DataFrame, ignored: Sequence[str]) -> DataFrame:
    """Destroyed units with their real type and whether the loss was a cancel.

    ``destroyed`` has type, progress, hallucination, cancel_issued, score_rise.
    """
    rows = destroyed.filter(~F.col("type").isin(*ignored) & ~F.col("hallucination"))
    rows = rows.join(values.select("type", "minerals"), "type").join(real_types, "type", "left")
    cancelled = (F.col("progress") < 1) & F.col("cancel_issued") & (F.col("minerals") > F.col("score_rise"))
    return rows.withColumn("real_type", F.coalesce("real_type", "type")).withColumn("cancelled", cancelled)


def merge_composition(known: DataFrame, guessed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Guessed counts added to known counts per type."""
    both = known.select(*keys, "count").unionByName(guessed.select(*keys, "count"))
    return both.filter(F.col("count") > 0).groupBy(*keys).agg(F.sum("count").alias("count"))


def static_defence(units: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct defending structures, their strength and how many hit air."""
    once = units.select(*keys, "tag", "type").distinct()
    per_type = once.groupBy(*keys, "type").agg(F.count(F.lit(1)).alias("_n")).join(values, "type")
    armed = per_type.filter(F.col("hits_ground") | F.col("shoots_air"))
    return armed.groupBy(*keys).agg(
        F.sum("_n").alias("defences"), F.sum(F.col("power") * F.col("_n")).alias("power"),
        F.sum(F.when(F.col("shoots_air"), F.col("_n")).otherwise(0)).alias("air"))
