"""Actions of trajectories joined to the tech graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions.vocabulary import ADDON_HOSTS, CONTROL_PRODUCTS, QUEUE_KINDS, RESEARCH_HOSTS
from stepforge.operators import actions as A
from stepforge.workload.graph_rows import graph, values_sql
from stepforge.workload.registry import query
from stepforge.workload.views import step, table, traj, traj_raw

KEYS = ["traj_id", "step_id"]
ITEM_KINDS = "('Build', 'BuildOnUnit', 'BuildInstant', 'Train', 'Morph', 'Research')"


@query("action_to_item", f"""
    SELECT event_id, traj.ability, CASE WHEN kind IN {ITEM_KINDS} THEN result END AS item
    FROM traj LEFT JOIN ability ON ability.ability = traj.ability""", using="traj ability")
def action_to_item(spark, sf):
    return A.action_to_item(traj_raw(spark, sf), graph(spark, "ability")).select("event_id", "ability", "item")


@query("action_to_item_lineitem", """
    SELECT p_type AS item, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_type <> 'PROMO' GROUP BY 1""")
def action_to_item_lineitem(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("ability"))
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ability"), F.col("p_type").alias("result"),
        F.when(F.col("p_type") == "PROMO", "Effect").otherwise("Build").alias("kind"))
    items = A.action_to_item(lines, parts).filter(F.col("item").isNotNull())
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


# Action names of every fallback tier, used to spell event actions.
SPELLINGS = [
    "BARRACKSTRAIN_MARINE",
    "MOVE_MOVE",
    "STOP",
    "MORPH_LIBERATORAGMODE",
    "MORPH_SUPPLYDEPOT_RAISE",
    "MORPH_OVERLORD_FAST",
    "EFFECT_STIM_MARINE",
    "CALLDOWNMULE_CALLDOWNMULE",
    "SCANNERSWEEP_SCAN",
    "KD8CHARGE_KD8CHARGE",
    "HARVEST_GATHER",
    "RALLY_UNITS",
    "CANCEL_QUEUE5",
    "TERRANBUILD_BUNKER",
    "BUILD_REACTOR_STARPORT",
    "FACTORYTRAIN_WIDOWMINE",
    "UPGRADETOORBITAL_ORBITALCOMMAND",
    "RESEARCH_HISECAUTOTRACKING",
    "SOMETHINGELSE",
    "",
]
SPELLED = ", ".join("'" + s + "'" for s in SPELLINGS)


def spelled(spark, sf):
    names = F.array(*[F.lit(s) for s in SPELLINGS])
    return traj_raw(spark, sf).select(
        "event_id", F.element_at(names, (F.col("k") % len(SPELLINGS) + 1).cast("int")).alias("ability"))


@query("action_to_product", f"""
    SELECT event_id, s.ability, CASE WHEN s.ability = '' THEN '(Unknown)' ELSE
           coalesce(a.result, CASE s.ability
               WHEN 'MOVE_MOVE' THEN '(Move)' WHEN 'STOP' THEN '(Stop)'
               WHEN 'MORPH_LIBERATORAGMODE' THEN 'Liberator (Agmode mode)'
               WHEN 'MORPH_SUPPLYDEPOT_RAISE' THEN 'Supplydepot (Raise mode)'
               WHEN 'MORPH_OVERLORD_FAST' THEN 'Overlord (Fast mode)'
               WHEN 'EFFECT_STIM_MARINE' THEN 'Stim Marine' WHEN 'CALLDOWNMULE_CALLDOWNMULE' THEN 'MULE'
               WHEN 'SCANNERSWEEP_SCAN' THEN 'ScannerSweep' WHEN 'KD8CHARGE_KD8CHARGE' THEN 'KD8Charge'
               WHEN 'HARVEST_GATHER' THEN 'Gather' WHEN 'RALLY_UNITS' THEN 'RallyPoint'
               WHEN 'CANCEL_QUEUE5' THEN '(Cancel)' WHEN 'TERRANBUILD_BUNKER' THEN 'Bunker'
               WHEN 'BUILD_REACTOR_STARPORT' THEN '(Unknown: BUILD_REACTOR_STARPORT)'
               WHEN 'FACTORYTRAIN_WIDOWMINE' THEN 'Widowmine'
               WHEN 'RESEARCH_HISECAUTOTRACKING' THEN 'HISECAUTOTRACKING' END,
               '(Unknown: ' || s.ability || ')') END AS product
    FROM (SELECT event_id, ([{SPELLED}])[k % {len(SPELLINGS)} + 1] AS ability FROM traj) s
    LEFT JOIN ability a ON s.ability = a.ability""", using="traj ability")
def action_to_product(spark, sf):
    return A.action_to_product(spelled(spark, sf), graph(spark, "ability")).select("event_id", "ability", "product")


@query("action_to_product_simple", f"""
    SELECT event_id, s.ability, coalesce(a.result,
        CASE WHEN contains(s.ability, '_') AND upper(list_extract(string_split(s.ability, '_'), -1))
             = list_extract(string_split(s.ability, '_'), -1)
             THEN list_extract(string_split(s.ability, '_'), -1) END, '(no product)') AS product
    FROM (SELECT event_id, ([{SPELLED}])[k % {len(SPELLINGS)} + 1] AS ability FROM traj) s
    LEFT JOIN ability a ON s.ability = a.ability""", using="traj ability")
def action_to_product_simple(spark, sf):
    rows = spelled(spark, sf).join(graph(spark, "ability"), "ability", "left")
    return rows.select("event_id", "ability", A.simple_product(F.col("ability"), F.col("result")).alias("product"))


@query("product_to_action", """
    SELECT event_id, result AS product, coalesce(back, '') AS ability FROM traj
    JOIN ability USING (ability) LEFT JOIN (
        SELECT result, max(ability) AS back FROM ability WHERE result IS NOT NULL GROUP BY result) USING (result)""",
       using="traj ability")
def product_to_action(spark, sf):
    ability = graph(spark, "ability")
    products = traj_raw(spark, sf).join(ability, "ability").select("event_id", F.col("result").alias("product"))
    back = ability.filter(F.col("result").isNotNull()).groupBy(F.col("result").alias("product")).agg(
        F.max("ability").alias("ability"))
    return products.join(back, "product", "left").select(
        "event_id", "product", F.coalesce("ability", F.lit("")).alias("ability"))


@query("annotate_actions", """
    SELECT event_id, traj.ability, coalesce(result, CASE WHEN contains(traj.ability, '_') AND upper(split_part(traj.ability, '_', -1)) = split_part(traj.ability, '_', -1) THEN split_part(traj.ability, '_', -1) END, '(no product)') AS product, coalesce(type, '-') AS type,
           coalesce(minerals, 0) AS minerals, coalesce(gas, 0) AS gas, coalesce(needs, '') AS requires,
           coalesce(is_structure, false) AS is_structure, coalesce(is_addon, false) AS is_addon,
           result IS NOT NULL AS has_product
    FROM traj LEFT JOIN ability ON ability.ability = traj.ability LEFT JOIN entity ON result = name""", using="traj ability entity")
def annotate_actions(spark, sf):
    ability, entity = graph(spark, "ability"), graph(spark, "entity")
    rows = traj_raw(spark, sf).join(ability, "ability", "left")
    rows = rows.join(entity, F.col("result") == F.col("name"), "left")
    return rows.select(
        "event_id", "ability", A.simple_product(F.col("ability"), F.col("result")).alias("product"),
        F.coalesce("type", F.lit("-")).alias("type"), F.coalesce("minerals", F.lit(0)).alias("minerals"),
        F.coalesce("gas", F.lit(0)).alias("gas"), F.coalesce("needs", F.lit("")).alias("requires"),
        F.coalesce("is_structure", F.lit(False)).alias("is_structure"),
        F.coalesce("is_addon", F.lit(False)).alias("is_addon"), F.col("result").isNotNull().alias("has_product"))


@query("action_cost", """
    SELECT traj_id, CAST(sum(minerals) AS BIGINT) AS minerals, CAST(sum(gas) AS BIGINT) AS gas,
           CAST(sum(supply) AS BIGINT) AS supply, round(sum(frames) / 22.4, 3) AS seconds,
           count(*) FILTER (name IS NULL) AS without_cost
    FROM traj JOIN ability USING (ability) LEFT JOIN entity ON result = name GROUP BY traj_id""",
       using="traj ability entity")
def action_cost(spark, sf):
    rows = traj_raw(spark, sf).join(graph(spark, "ability"), "ability").join(
        graph(spark, "entity"), F.col("result") == F.col("name"), "left")
    return rows.groupBy("traj_id").agg(
        F.sum("minerals").alias("minerals"), F.sum("gas").alias("gas"), F.sum("supply").alias("supply"),
        F.round(F.sum("frames") / 22.4, 3).alias("seconds"),
        F.count_if(F.col("name").isNull()).alias("without_cost"))


@query("cost_hint_lines", """
    SELECT DISTINCT traj_id, step_id, '  - ' || step.ability || ': minerals ' || coalesce(minerals, 0) || ', gas '
        || coalesce(gas, 0) || ', supply ' || coalesce(supply, 0) || ', ~'
        || CAST(CAST(round_even(coalesce(frames, 0) / 22.4, 0) AS BIGINT) AS VARCHAR) || 's' AS line
    FROM step JOIN ability USING (ability) LEFT JOIN entity ON result = name""", using="step ability entity")
def cost_hint_lines(spark, sf):
    rows = step(spark, sf).select(*KEYS, "ability").distinct().join(graph(spark, "ability"), "ability").join(
        graph(spark, "entity"), F.col("result") == F.col("name"), "left")
    zero = F.lit(0)
    seconds = F.bround(F.coalesce("frames", zero) / 22.4, 0).cast("bigint")
    return rows.select(*KEYS, F.concat(
        F.lit("  - "), "ability", F.lit(": minerals "), F.coalesce("minerals", zero), F.lit(", gas "),
        F.coalesce("gas", zero), F.lit(", supply "), F.coalesce("supply", zero), F.lit(", ~"), seconds,
        F.lit("s")).alias("line"))


@query("entity_to_actions", """
    SELECT event_id, entity, a.ability AS ability, kind, string_agg(unit, ',' ORDER BY unit) AS executors
    FROM (SELECT event_id, upper(name) AS entity FROM traj JOIN ability USING (ability) JOIN entity ON result = name) w
    JOIN ability a ON lower(a.result) = lower(entity) JOIN executor USING (ability)
    GROUP BY ALL""", using="traj ability executor entity")
def entity_to_actions(spark, sf):
    ability, executor = graph(spark, "ability"), graph(spark, "executor")
    rows = traj_raw(spark, sf).join(ability, "ability").join(graph(spark, "entity"), F.col("result") == F.col("name"))
    wanted = rows.select("event_id", F.upper("name").alias("entity"))
    # Names are looked up once each, then joined to the rows that asked.
    found = A.entity_actions(graph(spark, "entity").select(F.upper("name").alias("entity")), ability, executor)
    return wanted.join(found, "entity").select(
        "event_id", "entity", "ability", "kind", F.concat_ws(",", "executors").alias("executors"))


@query("primary_action", """
    SELECT traj_id, result AS entity, count(*) AS n, any_value(best) AS ability FROM traj JOIN ability USING (ability)
    JOIN (SELECT result, arg_min(ability, (CASE WHEN kind LIKE 'Build%' THEN 0 WHEN kind = 'Train' THEN 1
              WHEN kind = 'Research' THEN 2 WHEN kind = 'Morph' THEN 3 ELSE 9 END) || ability) AS best
          FROM ability WHERE result IS NOT NULL AND ability IN (SELECT ability FROM executor) GROUP BY result)
    USING (result) GROUP BY traj_id, result""", using="traj ability executor")
def primary_action(spark, sf):
    ability, executor = graph(spark, "ability"), graph(spark, "executor")
    entities = graph(spark, "entity").select(F.col("name").alias("entity"))
    best = A.primary_action(A.entity_actions(entities, ability, executor))
    asked = traj_raw(spark, sf).join(ability, "ability").groupBy("traj_id", F.col("result").alias("entity")).agg(
        F.count(F.lit(1)).alias("n"))
    return asked.join(best, "entity").select("traj_id", "entity", "n", "ability")


@query("canonical_name", """
    SELECT l_orderkey, l_linenumber, spelled, coalesce(p_brand, spelled) AS name
    FROM (SELECT l_orderkey, l_linenumber, upper(replace(returned, '#', '_')) AS spelled FROM
          (SELECT l_orderkey, l_linenumber, 'Brand#' || l_linenumber * 5 AS returned FROM lineitem))
    LEFT JOIN (SELECT DISTINCT p_brand FROM part)
      ON lower(replace(replace(spelled, '_', ''), ' ', '')) = lower(replace(p_brand, '#', ''))""")
def canonical_name(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.upper(F.concat(
        F.lit("Brand_"), (F.col("l_linenumber") * 5).cast("string"))).alias("spelled"))
    names = table(spark, sf, "part").select("p_brand").distinct().withColumn(
        "_key", F.lower(F.regexp_replace("p_brand", "#", "")))
    key = F.lower(F.regexp_replace("spelled", "[_ ]", ""))
    return lines.withColumn("_key", key).join(names, "_key", "left").select(
        "l_orderkey", "l_linenumber", "spelled", F.coalesce("p_brand", "spelled").alias("name"))


@query("alias_remap", """
    SELECT p.p_partkey, coalesce(r.p_name, p.p_name) AS resolved FROM part p
    LEFT JOIN part r ON CASE WHEN p.p_size % 3 = 0 THEN p.p_partkey // 2 END = r.p_partkey""")
def alias_remap(spark, sf):
    part = table(spark, sf, "part")
    entries = part.select("p_partkey", "p_name", F.when(
        F.col("p_size") % 3 == 0, F.floor(F.col("p_partkey") / 2)).alias("remap"))
    targets = part.select(F.col("p_partkey").alias("remap"), F.col("p_name").alias("target"))
    return entries.join(targets, "remap", "left").select("p_partkey", F.coalesce("target", "p_name").alias("resolved"))


@query("executor_index", """
    SELECT p_brand AS ability, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS units
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A' GROUP BY p_brand""")
def executor_index(spark, sf):
    used = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "A").select(F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("ability"), F.col("p_type").alias("unit"))
    return A.executor_index(parts.join(used, "p_partkey")).select("ability", F.concat_ws(",", "units").alias("units"))


RESOURCES = f"""resources AS (
    SELECT DISTINCT ability, coalesce(host, unit) AS resource FROM ability JOIN executor USING (ability)
    LEFT JOIN ({values_sql(['addon', 'host'], list(ADDON_HOSTS.items()))}) ON unit = addon
    WHERE kind IN ({', '.join("'" + k + "'" for k in QUEUE_KINDS)}) AND unit <> 'TechLab'
      AND NOT (unit = 'SCV' AND kind IN ('Build', 'BuildOnUnit'))
    UNION SELECT ability, host FROM ability JOIN ({values_sql(['ability', 'host'], list(RESEARCH_HOSTS.items()))}) h
    USING (ability))"""


@query("queue_resources", f"""
    WITH {RESOURCES} SELECT event_id, ability, resource FROM traj JOIN resources USING (ability)""",
       using="traj ability executor")
def queue_resources(spark, sf):
    resources = A.queue_resources(graph(spark, "ability"), graph(spark, "executor"))
    return traj_raw(spark, sf).join(resources, "ability").select("event_id", "ability", "resource")


@query("action_conflicts", f"""
    WITH {RESOURCES}, firsts AS (SELECT traj_id, step_id, ability, min(seq) AS f FROM step GROUP BY ALL)
    SELECT a.traj_id, a.step_id, a.ability AS left_action, b.ability AS right_action,
           string_agg(DISTINCT ra.resource, ', ' ORDER BY ra.resource) AS shared
    FROM firsts a JOIN firsts b ON a.traj_id = b.traj_id AND a.step_id = b.step_id AND a.f < b.f
    JOIN resources ra ON ra.ability = a.ability JOIN resources rb ON rb.ability = b.ability AND ra.resource = rb.resource
    GROUP BY a.traj_id, a.step_id, a.ability, b.ability""", using="step ability executor")
def action_conflicts(spark, sf):
    resources = A.queue_resources(graph(spark, "ability"), graph(spark, "executor"))
    found = A.action_conflicts(step(spark, sf), KEYS, resources, "seq")
    return found.withColumn("shared", F.concat_ws(", ", "shared"))


ACCEPTED = """accepted AS (
    SELECT ability, needs, needs AS alternative FROM ability WHERE needs IS NOT NULL
    UNION SELECT a.ability, a.needs, b.result FROM ability a JOIN ability b ON a.needs_action = b.ability
          WHERE a.needs IS NOT NULL AND b.result IS NOT NULL
    UNION SELECT ability, needs, unit FROM ability JOIN executor USING (ability)
          WHERE needs = 'TechLab' AND unit LIKE '%TechLab' AND unit <> 'TechLab')"""


@query("step_prereqs", f"""
    WITH {ACCEPTED}, present AS (SELECT DISTINCT traj_id, step_id, ability FROM step)
    SELECT DISTINCT p.traj_id, p.step_id, p.ability AS action, q.ability AS depends_on, c.alternative AS via
    FROM present p JOIN accepted c ON p.ability = c.ability JOIN ability m ON m.result = c.alternative
    JOIN present q ON q.traj_id = p.traj_id AND q.step_id = p.step_id AND q.ability = m.ability
    WHERE p.ability <> q.ability""", using="step ability executor")
def step_prereqs(spark, sf):
    return A.step_prereqs(step(spark, sf), KEYS, graph(spark, "ability"), graph(spark, "executor"))
