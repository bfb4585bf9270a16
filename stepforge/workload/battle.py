"""Games of units: suppliers as games, line items as units."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.operators import spatial as S
from stepforge.plans import battle as B
from stepforge.workload.graph_rows import graph, values_frame
from stepforge.workload.registry import query
from stepforge.workload.spatial import ZONES_SQL, zones
from stepforge.workload.views import hour_of, pos, table, units

POWER_SQL = """
    sum(power) AS power, sum(CASE WHEN flying THEN power ELSE 0 END) AS air_presence,
    sum(CASE WHEN flying THEN 0 ELSE power END) AS ground_presence,
    sum(CASE WHEN shoots_air AND weak_air THEN 0.5 WHEN shoots_air THEN power ELSE 0 END) AS air_power,
    sum(CASE WHEN hits_ground THEN power ELSE 0 END) AS ground_power,
    sum(CASE WHEN hits_ground AND melee THEN power ELSE 0 END) AS melee_power,
    sum(CASE WHEN hits_ground AND surround THEN power ELSE 0 END) AS surround_power,
    sum(CASE WHEN siege THEN power ELSE 0 END) AS siege_power,
    sum(CASE WHEN cloak THEN power ELSE 0 END) AS stealth_power,
    CAST(count(*) FILTER (detector) AS BIGINT) AS detectors"""

SIDES_SQL = """vec AS (SELECT {key}, mine, """ + POWER_SQL + """ FROM {units} JOIN unit_values USING (type) GROUP BY ALL),
    sides AS (SELECT {key}, coalesce(o.power, 0) AS op, coalesce(o.air_power, 0) AS oa, coalesce(o.ground_power, 0) AS og,
              coalesce(o.air_presence, 0) AS oap, coalesce(o.ground_presence, 0) AS ogp,
              coalesce(e.power, 0) AS ep, coalesce(e.air_power, 0) AS ea, coalesce(e.ground_power, 0) AS eg,
              coalesce(e.air_presence, 0) AS eap, coalesce(e.ground_presence, 0) AS egp
       FROM (SELECT * FROM vec WHERE mine) o FULL JOIN (SELECT * FROM vec WHERE NOT mine) e USING ({key}))"""


def skirmish(spark, sf):
    """Fights: an order is a fight of the units on its lines."""
    return units(spark, sf).withColumn("fight", F.col("tag"))


@query("power_vector", f"SELECT game, mine, {POWER_SQL} FROM units JOIN unit_values USING (type) GROUP BY game, mine",
       using="units unit_values")
def power_vector(spark, sf):
    return B.power_vector(units(spark, sf), ["game", "mine"], graph(spark, "unit_values"))


@query("power_verdict", "WITH " + SIDES_SQL.format(key="tag", units="units") + """
    SELECT tag AS fight, op >= 1 AND oa * 1.1 >= eap AND og * 1.1 >= egp AND op * 1.1 >= ep AS own_wins,
           ep >= 1 AND ea * 1.1 >= oap AND eg * 1.1 >= ogp AND ep * 1.1 >= op AS enemy_wins FROM sides""",
       using="units unit_values")
def power_verdict(spark, sf):
    rows = B.sides(skirmish(spark, sf), ["fight"], graph(spark, "unit_values"))
    return rows.select("fight", B.enough_for("own", "enemy", 1.1).alias("own_wins"),
                       B.enough_for("enemy", "own", 1.1).alias("enemy_wins"))


ZONED_SQL = f"""{ZONES_SQL}, zoned AS (SELECT u.*, z.zone FROM units u JOIN (
    SELECT x, y, arg_min(zone, (sqrt((x - cx) ** 2 + (y - cy) ** 2) + CASE WHEN neutral THEN 5 ELSE 0 END
           + abs(0 - height) * 10, zone)) AS zone
    FROM (SELECT DISTINCT x, y FROM pos), zones WHERE (x - cx) ** 2 + (y - cy) ** 2 <= 900 GROUP BY x, y) z
    ON u.x = z.x AND u.y = z.y)"""


def zoned(spark, sf):
    rows = units(spark, sf).withColumn("height", F.lit(0))
    return S.zone_assign(rows, zones(spark, sf), 30.0)


# Every third zone is ours and every third the enemy's; mineral lines lie beside the middle.
OWNED_SQL = """owned AS (SELECT *, zone % 3 = 0 AS ours, zone % 3 = 1 AS enemys, cx + 7 AS lx, cy AS ly FROM zones),
    foes AS (SELECT x, y, power, hits_ground, worker FROM units JOIN unit_values USING (type) WHERE NOT mine AND game % 25 = 1),
    near AS (SELECT zone, sum(CASE WHEN (x - cx) ** 2 + (y - cy) ** 2 <= 144 THEN power END) AS assault,
        sum(CASE WHEN (x - lx) ** 2 + (y - ly) ** 2 <= 100 AND hits_ground THEN power END) AS ground,
        count(*) FILTER ((x - lx) ** 2 + (y - ly) ** 2 <= 100 AND NOT worker) AS fighters FROM owned, foes WHERE ours GROUP BY zone),
    states AS (SELECT zone, ours, enemys, coalesce(op, 0) AS op, coalesce(ep, 0) AS ep, coalesce(assault, 0) AS assault,
        coalesce(ground > 3 AND fighters > 0, false) AS evacuate, round(coalesce(op, 0) - coalesce(ep, 0), 1) AS balance
        FROM owned LEFT JOIN sides USING (zone) LEFT JOIN near USING (zone))"""
ZONE_STATES_SQL = f"WITH {ZONED_SQL}, " + SIDES_SQL.format(key="zone", units="(SELECT * FROM zoned WHERE game % 7 < 5)") + ", " + OWNED_SQL


def zone_states(spark, sf):
    middle = zones(spark, sf)
    owned = middle.select("zone", "cx", "cy", (F.col("cx") + 7).alias("lx"), F.col("cy").alias("ly"),
                          (F.col("zone") % 3 == 0).alias("ours"), (F.col("zone") % 3 == 1).alias("enemys"))
    rows = zoned(spark, sf).filter(F.col("game") % 7 < 5)
    foes = units(spark, sf).filter(~F.col("mine") & (F.col("game") % 25 == 1))
    return B.zone_states(rows, foes, owned, graph(spark, "unit_values"), 12.0)


@query("zone_balance", ZONE_STATES_SQL + """
    SELECT zone, balance, (ours AND assault > 5) OR balance < 1 OR (enemys AND balance > 0) AS under_attack FROM states""",
       using="units pos unit_values")
def zone_balance(spark, sf):
    return zone_states(spark, sf).select("zone", "balance", "under_attack")


@query("zone_state", ZONE_STATES_SQL + """, seen AS (SELECT zone, max(us) FILTER (flag = 'A') AS last_scouted FROM zoned GROUP BY zone)
    SELECT zone, op AS own_power, ep AS enemy_power, assault AS assault_power, evacuate, last_scouted FROM states LEFT JOIN seen USING (zone)""",
       using="units pos unit_values")
def zone_state(spark, sf):
    seen = zoned(spark, sf).groupBy("zone").agg(F.max(F.when(F.col("flag") == "A", F.col("us"))).alias("last_scouted"))
    return zone_states(spark, sf).join(seen, "zone", "left").select(
        "zone", "own_power", "enemy_power", "assault_power", "evacuate", "last_scouted")


@query("zone_worker_window", """
    WITH z AS (SELECT l_orderkey, l_suppkey AS zone, l_suppkey % 5 * 100 AS before, max(epoch_us(l_shipdate)) // 1000000 AS now,
        bool_or(l_returnflag = 'A' AND l_tax = 0) AS ours, bool_or(l_returnflag = 'R' AND l_tax > 0.03) AS enemys, bool_or(l_linestatus = 'F') AS visible,
        bool_or(l_returnflag = 'R' AND l_quantity > 40) AS workers,
        max(epoch_us(l_shipdate) // 1000000 + l_linenumber % 2 * 71) FILTER (l_discount > 0.05) AS finished,
        max(epoch_us(l_shipdate)) FILTER (l_linenumber > 2) // 1000000 AS scouted FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, zone, CASE WHEN visible AND enemys AND workers THEN 0
        WHEN visible AND enemys AND finished IS NOT NULL THEN CASE WHEN finished > now THEN finished ELSE now END + 60
        WHEN NOT visible AND scouted IS NULL THEN 180 WHEN NOT visible AND (ours OR enemys) THEN scouted + 161
        WHEN ours THEN now + 300 ELSE before END AS until FROM z""")
def zone_worker_window(spark, sf):
    rows = table(spark, sf, "lineitem")
    seconds = lambda name: F.unix_seconds(F.col(name).cast("timestamp"))
    flag, line, supplier = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_suppkey")
    until = B.worker_window(
        before=F.col("l_suppkey") % 5 * 100, now=F.max(seconds("l_shipdate")), ours=F.bool_or((flag == "A") & (F.col("l_tax") == 0)),
        enemys=F.bool_or((flag == "R") & (F.col("l_tax") > 0.03)), visible=F.bool_or(F.col("l_linestatus") == "F"),
        workers_seen=F.bool_or((flag == "R") & (F.col("l_quantity") > 40)),
        finished=F.max(F.when(F.col("l_discount") > 0.05, seconds("l_shipdate") + line % 2 * 71)),
        scouted=F.max(F.when(line > 2, seconds("l_shipdate"))), build_time=71)
    return rows.groupBy("l_orderkey", "l_suppkey").agg(until.alias("until")).select("l_orderkey", supplier.alias("zone"), "until")


@query("known_counts", """
    SELECT game, type, count(*) - sum(m) AS count FROM (
        SELECT game, type, tag, max(CAST(line = 7 AS INTEGER)) AS m FROM units u
        WHERE NOT mine AND type <> 'ECONOMY' AND flag <> 'N' AND progress <> 0.5
          AND NOT EXISTS (SELECT 1 FROM units d WHERE d.game = u.game AND d.tag = u.tag AND d.flag = 'N')
        GROUP BY game, type, tag) GROUP BY game, type""", using="units")
def known_counts(spark, sf):
    return enemy_counts(spark, sf)


def enemy_counts(spark, sf):
    rows = units(spark, sf)
    sightings = rows.filter(~F.col("mine")).select(
        "game", "tag", "type", (F.col("flag") == "N").alias("snapshot"),
        (F.col("progress") == 0.5).alias("hallucination"), (F.col("line") == 7).alias("morphed"))
    return B.known_counts(sightings, rows.filter(F.col("flag") == "N"), ["game"], ["ECONOMY"])


@query("known_power", """
    SELECT game, sum(power * n) AS power FROM (SELECT game, type, count(*) - sum(m) AS n FROM (
        SELECT game, type, tag, max(CAST(line = 7 AS INTEGER)) AS m FROM units u
        WHERE NOT mine AND type <> 'ECONOMY' AND flag <> 'N' AND progress <> 0.5
          AND NOT EXISTS (SELECT 1 FROM units d WHERE d.game = u.game AND d.tag = u.tag AND d.flag = 'N')
        GROUP BY game, type, tag) GROUP BY game, type) JOIN unit_values USING (type)
    WHERE NOT worker AND type <> 'SMALL' GROUP BY game""", using="units unit_values")
def known_power(spark, sf):
    return B.known_power(enemy_counts(spark, sf), ["game"], graph(spark, "unit_values"), "SMALL")


@query("income_rate", """
    SELECT l_suppkey AS game, sum(CASE WHEN l_returnflag <> 'R' THEN least(l_quantity, 16)
               + greatest(l_quantity - 16, 0) * 0.5 ELSE 0 END) AS minerals,
           round(sum(CASE WHEN l_returnflag = 'R' THEN least(l_quantity, 16) ELSE 0 END) * 0.9433962264150943, 4) AS gas
    FROM lineitem GROUP BY l_suppkey""")
def income_rate(spark, sf):
    bases = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("game"), F.col("l_quantity").alias("assigned"), F.lit(16.0).alias("ideal"),
        (F.col("l_returnflag") == "R").alias("gas"))
    return B.income_rate(bases, ["game"]).withColumn("gas", F.round("gas", 4))


@query("ideal_workers", """
    SELECT l_suppkey AS game, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 3 ELSE 2 * l_linenumber END) AS BIGINT) AS ideal
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_suppkey""")
def ideal_workers(spark, sf):
    ready = table(spark, sf, "lineitem").filter(F.col("l_linestatus") == "F")
    slots = F.when(F.col("l_returnflag") == "R", 3).otherwise(2 * F.col("l_linenumber"))
    return ready.groupBy(F.col("l_suppkey").alias("game")).agg(F.sum(slots).alias("ideal"))


@query("lost_resources", """
    SELECT game, mine, sum(minerals * w) AS minerals, sum(gas * w) AS gas FROM (
        SELECT game, mine, type, CASE WHEN progress < 0.3 THEN 0.25 ELSE 1 END AS w FROM units WHERE flag = 'R')
    JOIN unit_values USING (type) GROUP BY game, mine""", using="units unit_values")
def lost_resources(spark, sf):
    lost = units(spark, sf).filter(F.col("flag") == "R").withColumn("cancelled", F.col("progress") < 0.3)
    return B.lost_resources(lost, ["game", "mine"], graph(spark, "unit_values"))


@query("loss_events", """
    SELECT game, mine, CASE WHEN type = 'PROMO' THEN 'LARGE' ELSE type END AS real_type, count(*) AS lost,
           count(*) FILTER (progress < 1 AND line > 4 AND minerals > size) AS cancelled
    FROM units JOIN unit_values USING (type) WHERE flag = 'R' AND type <> 'ECONOMY' AND assigned <> 13
    GROUP BY ALL""", using="units unit_values")
def loss_events(spark, sf):
    destroyed = units(spark, sf).filter(F.col("flag") == "R").select(
        "game", "mine", "type", "progress", (F.col("assigned") == 13).alias("hallucination"),
        (F.col("line") > 4).alias("cancel_issued"), F.col("size").alias("score_rise"))
    real = values_frame(spark, ["type", "real_type"], [("PROMO", "LARGE")])
    rows = B.loss_events(destroyed, graph(spark, "unit_values"), real, ["ECONOMY"])
    return rows.groupBy("game", "mine", "real_type").agg(
        F.count(F.lit(1)).alias("lost"), F.count_if("cancelled").alias("cancelled"))


@query("alive_dead", """
    SELECT game, mine, type, count(*) AS total, count(*) FILTER (flag <> 'R') AS alive,
           count(*) FILTER (flag = 'R') AS dead FROM units GROUP BY ALL""", using="units")
def alive_dead(spark, sf):
    rows = units(spark, sf)
    return B.alive_dead(rows.filter(F.col("flag") != "R"), rows.filter(F.col("flag") == "R"), ["game", "mine", "type"])


@query("army_value", """
    SELECT game, CAST(sum(minerals) AS BIGINT) AS minerals, CAST(sum(gas) AS BIGINT) AS gas
    FROM units JOIN unit_values USING (type) WHERE mine AND NOT worker GROUP BY game""", using="units unit_values")
def army_value(spark, sf):
    counted = units(spark, sf).filter("mine").groupBy("game", "type").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.join(graph(spark, "unit_values"), "type").filter(~F.col("worker"))
    return rows.groupBy("game").agg(F.sum(F.col("minerals") * F.col("n")).alias("minerals"),
                                    F.sum(F.col("gas") * F.col("n")).alias("gas"))


@query("merge_composition", """
    SELECT game, type, CAST(sum(n) AS BIGINT) AS count FROM (
        SELECT game, type, count(*) AS n FROM units WHERE flag = 'A' GROUP BY ALL
        UNION ALL SELECT game, type, CAST(count(*) // 4 AS BIGINT) FROM units WHERE flag = 'N' GROUP BY game, type)
    WHERE n > 0 GROUP BY game, type""", using="units")
def merge_composition(spark, sf):
    rows = units(spark, sf)
    known = rows.filter(F.col("flag") == "A").groupBy("game", "type").agg(F.count(F.lit(1)).alias("count"))
    guessed = rows.filter(F.col("flag") == "N").groupBy("game", "type").agg(
        F.floor(F.count(F.lit(1)) / 4).alias("count"))
    return B.merge_composition(known, guessed, ["game", "type"])


@query("static_defence", """
    SELECT game, count(*) AS defences, sum(power) AS power, count(*) FILTER (shoots_air) AS air FROM (
        SELECT DISTINCT game, tag, type FROM units WHERE NOT mine AND size > 25) JOIN unit_values USING (type)
    WHERE hits_ground OR shoots_air GROUP BY game""", using="units unit_values")
def static_defence(spark, sf):
    static = units(spark, sf).filter(~F.col("mine") & (F.col("size") > 25))
    return B.static_defence(static, graph(spark, "unit_values"), ["game"])


@query("queue_counts", """
    WITH t AS (SELECT game, CASE WHEN flag = 'A' THEN 'completed' WHEN type IN ('LARGE', 'PROMO')
                   THEN 'under_construction' ELSE 'active_queues' END AS tier, type, flag, line FROM units),
    n AS (SELECT game, tier, CASE WHEN tier = 'active_queues' THEN 'Training ' || type ELSE type END AS name FROM t
          UNION ALL SELECT game, 'active_queues', 'Training ' || (['MARINE', 'HELLION'])[line % 2 + 1] FROM t
          WHERE flag = 'A' AND type IN ('LARGE', 'PROMO') AND line < 5)
    SELECT game, tier, name, count(*) AS n FROM n GROUP BY ALL""", using="units")
def queue_counts(spark, sf):
    rows = units(spark, sf).select(
        "game", "type", F.col("type").isin("LARGE", "PROMO").alias("structure"), (F.col("flag") == "A").alias("ready"),
        F.when(F.col("line") < 5, F.when(F.col("line") % 2 == 1, "HELLION").otherwise("MARINE")).alias("queued"))
    maps = B.tiered_counts(rows, ["game"])
    tiers = [maps.select("game", F.lit(t).alias("tier"), F.explode(t).alias("name", "n"))
             for t in ("completed", "under_construction", "active_queues")]
    return tiers[0].unionByName(tiers[1]).unionByName(tiers[2])


PENDING_SQL = """pending AS (SELECT game, ability, count(*) AS pending, coalesce(max(p), 0) AS progress FROM (
        SELECT game, 'TRAIN_' || type AS ability, NULL AS p FROM units WHERE line <= 2
        UNION ALL SELECT game, 'MAKE_' || type, progress FROM units WHERE progress < 1) GROUP BY game, ability)"""


def pending(spark, sf):
    rows = units(spark, sf).select(
        "game", F.when(F.col("line") <= 2, F.concat(F.lit("TRAIN_"), "type")).alias("ability"),
        F.concat(F.lit("MAKE_"), "type").alias("creation"), (F.col("progress") >= 1).alias("ready"), "progress")
    return B.pending_abilities(rows, ["game"])


@query("pending_abilities", f"WITH {PENDING_SQL} SELECT game, ability, pending, progress FROM pending", using="units")
def pending_abilities(spark, sf):
    return pending(spark, sf)


@query("pending_count", f"""WITH {PENDING_SQL} SELECT game, type, coalesce(pending, 0) AS pending
    FROM (SELECT DISTINCT game, type FROM units) LEFT JOIN pending USING (game)
    WHERE ability = 'TRAIN_' || type""", using="units")
def pending_count(spark, sf):
    asked = units(spark, sf).select("game", "type").distinct().withColumn("ability", F.concat(F.lit("TRAIN_"), "type"))
    return asked.join(pending(spark, sf), ["game", "ability"]).select("game", "type", "pending")


@query("type_progress", """
    SELECT g.game, w.wanted, coalesce(max(progress), 0) AS progress FROM (SELECT DISTINCT game FROM units) g
    CROSS JOIN (VALUES ('SMALL', 'SMALL'), ('SMALL', 'MEDIUM'), ('LARGE', 'LARGE'), ('LARGE', 'PROMO'),
                       ('ABSENT', 'ABSENT')) w(wanted, type)
    LEFT JOIN units u ON u.game = g.game AND u.type = w.type AND u.mine GROUP BY g.game, w.wanted""", using="units")
def type_progress(spark, sf):
    rows = units(spark, sf)
    names = F.array(*[F.lit(t) for t in ("SMALL", "LARGE", "ABSENT")])
    wanted = rows.select("game").distinct().select("game", F.explode(names).alias("wanted"))
    aliases = values_frame(spark, ["type", "alias"], [("SMALL", "MEDIUM"), ("LARGE", "PROMO")])
    return B.type_progress(wanted, rows.filter("mine"), aliases, ["game"])


@query("local_entities", """
    SELECT type, string_agg(DISTINCT p_name, ',' ORDER BY p_name) FILTER (size >= 25) AS completed,
           string_agg(DISTINCT p_name, ',' ORDER BY p_name) FILTER (size < 25) AS in_progress, '' AS pending
    FROM pos JOIN part ON tag = p_partkey GROUP BY type""", using="pos")
def local_entities(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("tag"), F.col("p_name").alias("name"))
    rows = pos(spark, sf).join(names, "tag").withColumn("progress", F.col("size") / 25)
    sets = B.local_entities(rows, ["type"])
    return sets.select("type", *[F.concat_ws(",", c).alias(c) for c in ("completed", "in_progress", "pending")])


@query("score_table", """
    SELECT game, 'spent' AS score, round(sum(price), 2) AS value FROM units GROUP BY game
    UNION ALL SELECT game, 'killed', round(sum(price) FILTER (NOT mine AND flag = 'R'), 2) FROM units GROUP BY game
    UNION ALL SELECT game, 'lost', round(sum(price) FILTER (mine AND flag = 'R'), 2) FROM units GROUP BY game
    UNION ALL SELECT game, 'workers', CAST(sum(assigned) AS DOUBLE) FROM units GROUP BY game""", using="units")
def score_table(spark, sf):
    lost = F.col("flag") == "R"
    wide = units(spark, sf).groupBy("game").agg(
        F.round(F.sum("price"), 2).alias("spent"),
        F.round(F.sum(F.when(~F.col("mine") & lost, F.col("price"))), 2).alias("killed"),
        F.round(F.sum(F.when(F.col("mine") & lost, F.col("price"))), 2).alias("lost"),
        F.sum("assigned").cast("double").alias("workers"))
    return wide.unpivot("game", ["spent", "killed", "lost", "workers"], "score", "value")


ARMY_SQL = """CASE WHEN {a}p >= 1 AND {a}a * (1 / 1.1e0) >= {b}ap AND {a}g * (1 / 1.1e0) >= {b}gp AND {a}p * (1 / 1.1e0) >= {b}p THEN
    CASE WHEN {a}p > 20 AND {a}a * (1 / 3e0) >= {b}ap AND {a}g * (1 / 3e0) >= {b}gp AND {a}p * (1 / 3e0) >= {b}p THEN 'Overwhelming{w}'
         WHEN {a}p > 10 AND {a}a * (1 / 2e0) >= {b}ap AND {a}g * (1 / 2e0) >= {b}gp AND {a}p * (1 / 2e0) >= {b}p THEN 'Clear{w}'
         WHEN {a}p > 5 AND {a}a * (1 / 1.4e0) >= {b}ap AND {a}g * (1 / 1.4e0) >= {b}gp AND {a}p * (1 / 1.4e0) >= {b}p THEN 'Small{w}'
         ELSE 'Slight{w}' END"""
INCOME_SQL = """CASE WHEN {n} > 40 THEN 'OverwhelmingAdvantage' WHEN {n} < -40 THEN 'OverwhelmingDisadvantage'
    WHEN {n} > 20 THEN 'ClearAdvantage' WHEN {n} < -20 THEN 'ClearDisadvantage' WHEN {n} > 10 THEN 'SmallAdvantage'
    WHEN {n} < -10 THEN 'SmallDisadvantage' WHEN {n} > 5 THEN 'SlightAdvantage' WHEN {n} < -5 THEN 'SlightDisadvantage'
    ELSE 'Even' END"""


@query("advantage_bucket", f"""
    SELECT event_id, {INCOME_SQL.format(n="n")} AS income, CASE WHEN share > 0.9 THEN 'AllAir' WHEN share > 0.65
        THEN 'AlmostAllAir' WHEN share > 0.35 THEN 'Mixed' WHEN share > 0 THEN 'SomeAir' ELSE 'NoAir' END AS air
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) - 50 AS n,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) / 100.0 AS share FROM events)""")
def advantage_bucket(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf, "events").select(
        "event_id", B.income_bucket(k - 50).alias("income"), B.air_bucket(k / 100).alias("air"))


@query("advantage_report", "WITH " + SIDES_SQL.format(key="tag", units="units") + f""",
    guess AS (SELECT tag, type, count(*) AS n FROM units WHERE NOT mine GROUP BY ALL
        UNION ALL SELECT tag, 'MEDIUM', count(*) * 2 FROM units WHERE NOT mine AND type = 'ECONOMY' GROUP BY tag),
    predicted AS (SELECT tag, sum(power * n) AS ep, sum(CASE WHEN flying THEN power * n ELSE 0 END) AS eap,
        sum(CASE WHEN flying THEN 0 ELSE power * n END) AS egp,
        sum(CASE WHEN NOT shoots_air THEN 0 WHEN weak_air THEN n * 0.5 ELSE power * n END) AS ea,
        sum(CASE WHEN hits_ground THEN power * n ELSE 0 END) AS eg FROM guess JOIN unit_values USING (type) GROUP BY tag),
    econ AS (SELECT tag, sum(CASE WHEN mine THEN assigned ELSE -assigned END) AS income,
             count(DISTINCT type) FILTER (mine) - count(DISTINCT type) FILTER (NOT mine) AS zones,
             count(*) FILTER (mine AND type = 'ECONOMY') AS workers FROM units GROUP BY tag),
    known AS (SELECT tag, {ARMY_SQL.format(a="o", b="e", w="Advantage")} ELSE
        {ARMY_SQL.format(a="e", b="o", w="Disadvantage")} ELSE 'Even' END END AS army_advantage FROM sides),
    foreseen AS (SELECT tag, op, oa, og, oap, ogp, coalesce(p.ep, 0) AS ep, coalesce(p.ea, 0) AS ea, coalesce(p.eg, 0) AS eg,
        coalesce(p.eap, 0) AS eap, coalesce(p.egp, 0) AS egp FROM sides LEFT JOIN predicted p USING (tag)),
    b AS (SELECT tag, {INCOME_SQL.format(n="(income + zones * 10)")} AS income_advantage,
        {ARMY_SQL.format(a="o", b="e", w="Advantage")} ELSE
        {ARMY_SQL.format(a="e", b="o", w="Disadvantage")} ELSE 'Even' END END AS army_predicted,
        CASE WHEN eap > 0 THEN ea / ep ELSE 0 END AS air, workers FROM foreseen JOIN econ USING (tag))
    SELECT tag AS fight, income_advantage, army_advantage, army_predicted, CASE WHEN air > 0.9 THEN 'AllAir' WHEN air > 0.65
        THEN 'AlmostAllAir' WHEN air > 0.35 THEN 'Mixed' WHEN air > 0 THEN 'SomeAir' ELSE 'NoAir' END AS enemy_air,
        army_predicted = 'OverwhelmingAdvantage' AND income_advantage = 'OverwhelmingAdvantage' AS victory,
        army_predicted = 'OverwhelmingDisadvantage'
            AND (workers < 5 OR income_advantage = 'OverwhelmingDisadvantage') AS defeat FROM b JOIN known USING (tag)""",
       using="units unit_values")
def advantage_report(spark, sf):
    rows, values = skirmish(spark, sf), graph(spark, "unit_values")
    strength = B.sides(rows, ["fight"], values)
    per_type = rows.groupBy("fight", "mine", "type").agg(
        F.sum("assigned").alias("a"), F.count(F.lit(1)).alias("n"))
    sign = F.when(F.col("mine"), 1).otherwise(-1)
    economy = per_type.groupBy("fight").agg(
        F.sum(F.col("a") * sign).alias("income"), F.sum(sign).alias("zones"),
        B.zero_if_null(F.sum(F.when(F.col("mine") & (F.col("type") == "ECONOMY"), F.col("n")))).alias("workers"))
    known = per_type.filter(~F.col("mine")).select("fight", "type", F.col("n").alias("count"))
    # Every enemy worker seen lets two more soldiers be expected.
    guessed = known.filter(F.col("type") == "ECONOMY").select("fight", F.lit("MEDIUM").alias("type"), (F.col("count") * 2).alias("count"))
    predicted = B.counted_strength(B.merge_composition(known, guessed, ["fight", "type"]), ["fight"], values)
    nothing = F.struct(*[F.lit(0.0).alias(n) for n in ("power", "air_presence", "ground_presence", "air_power", "ground_power")])
    games = strength.join(economy, "fight").join(predicted, "fight", "left").withColumn("predicted", F.coalesce("predicted", nothing))
    return B.advantage_report(games).select(
        "fight", "income_advantage", "army_advantage", "army_predicted", "enemy_air", "victory", "defeat")


@query("supply_cost", """
    SELECT game, type, cost, cost <= 0 OR cost <= room AS can_feed FROM (
        SELECT type, CASE type WHEN 'SMALL' THEN 1 ELSE CAST(minerals // 50 AS BIGINT) - coalesce(used, 0) END AS cost
        FROM unit_values LEFT JOIN (VALUES ('LARGE', 1), ('PROMO', 2)) p(type, used) USING (type))
    JOIN (SELECT game, type, 4 - count(*) % 8 AS room FROM units GROUP BY ALL) USING (type)""", using="units unit_values")
def supply_cost(spark, sf):
    types = graph(spark, "unit_values").select("type", F.floor(F.col("minerals") / 50).alias("supply"),
                                               F.when(F.col("type") == "SMALL", F.lit(1).cast("bigint")).alias("special"))
    producers = values_frame(spark, ["type", "used_supply"], [("LARGE", 1), ("PROMO", 2)])
    costs = B.supply_cost(types, producers)
    room = units(spark, sf).groupBy("game", "type").agg((4 - F.count(F.lit(1)) % 8).alias("room"))
    return room.join(costs, "type").select("game", "type", "cost",
                                           B.affordable(F.col("cost"), F.col("room")).alias("can_feed"))


@query("cost_affordable", """
    SELECT game, type, minerals <= bank AND gas <= bank / 2 AND supply <= room AS affordable
    FROM (SELECT game, CAST(sum(assigned) % 200 AS BIGINT) AS bank, count(*) % 4 AS room FROM units GROUP BY game)
    CROSS JOIN (SELECT type, minerals, gas, CAST(minerals // 50 AS BIGINT) AS supply FROM unit_values)""",
       using="units unit_values")
def cost_affordable(spark, sf):
    banks = units(spark, sf).groupBy("game").agg(
        (F.sum("assigned") % 200).alias("bank"), (F.count(F.lit(1)) % 4).alias("room"))
    names = F.array(*[F.lit(t) for t in ("ECONOMY", "STANDARD", "SMALL", "MEDIUM", "LARGE", "PROMO")])
    asked = banks.withColumn("type", F.explode(names)).join(graph(spark, "unit_values"), "type")
    enough = ((F.col("minerals") <= F.col("bank")) & (F.col("gas") <= F.col("bank") / 2)
              & (F.floor(F.col("minerals") / 50) <= F.col("room")))
    return asked.select("game", "type", enough.alias("affordable"))


@query("zone_minerals", """
    WITH v AS (SELECT game AS zone, us AS visit, CAST(sum(CASE WHEN mine THEN price WHEN type = 'SMALL' THEN 900
                   ELSE 1800 END) AS DOUBLE) AS total FROM units GROUP BY ALL),
    s AS (SELECT zone, visit, total, min(total) OVER (PARTITION BY zone ORDER BY visit) AS stored FROM v)
    SELECT zone, visit, round(total, 2) AS total, round(stored, 2) AS stored, CASE WHEN stored >= 10000 THEN 'Full'
        WHEN stored >= 5000 THEN 'Plenty' WHEN stored >= 1500 THEN 'Limited' WHEN stored > 0 THEN 'NearEmpty'
        ELSE 'Empty' END AS band FROM s""", using="units")
def zone_minerals(spark, sf):
    patches = units(spark, sf).select(
        F.col("game").alias("zone"), F.col("us").alias("visit"), F.col("mine").alias("visible"),
        F.col("price").alias("contents"), F.when(F.col("type") == "SMALL", "PATCH750").otherwise("PATCH").alias("type"))
    rows = B.mineral_total(patches, "zone", hour_of("visit"))
    return rows.select("zone", "visit", F.round("total", 2).alias("total"), F.round("stored", 2).alias("stored"), "band")


@query("started_before", """
    SELECT game, bool_or(us / 1e6 - progress * 2000000 < 867715200) AS before FROM units
    WHERE type = 'LARGE' AND NOT mine GROUP BY game""", using="units")
def started_before(spark, sf):
    start = F.col("us") / 1e6 - F.col("progress") * 2000000
    rows = units(spark, sf).filter((F.col("type") == "LARGE") & ~F.col("mine"))
    return rows.groupBy("game").agg(F.bool_or(start < 867715200).alias("before"))
