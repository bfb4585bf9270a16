"""Trajectories of events cut into steps and annotated."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.functions.vocabulary import (
    BOUNDARY_ACTIONS, GAS_HEAVY_ACTIONS, IMPLIED_ENTITIES, PRODUCTION_ACTIONS, WORKER_ACTIONS,
)
from stepforge.operators import actions as A
from stepforge.operators.closure import held_with, implied_pairs
from stepforge.operators.ordered import even_blocks, numbered
from stepforge.plans import steps as P
from stepforge.session import cut_lineage
from stepforge.workload.graph_joins import ACCEPTED, RESOURCES
from stepforge.workload.graph_rows import graph, values_frame, values_sql
from stepforge.workload.registry import query
from stepforge.workload.views import HOUR, hour_of, sql_list, step, table, text_array, traj, traj_raw

KEYS = ["traj_id", "step_id"]


def quoted(names):
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


STICKY_SQL = """('BUILD_TECHLAB_FACTORY', 'BUILD_TECHLAB_STARPORT', 'BUILD_TECHLAB_BARRACKS',
    'BUILD_REACTOR_BARRACKS', 'BUILD_REACTOR_FACTORY', 'BUILD_REACTOR_STARPORT')"""
SCORE_SQL = f"""scored AS (SELECT traj_id, seq, ability, event_id, CASE WHEN seq = 0 THEN -1.0
    WHEN ability IN {STICKY_SQL} THEN -0.5 WHEN ability NOT IN {quoted(BOUNDARY_ACTIONS)} THEN 0.2
    WHEN seq = min(CASE WHEN seq > 0 THEN seq END) OVER (PARTITION BY traj_id, ability) THEN 1.0 ELSE 0.8 END AS score
    FROM traj)"""
SPLIT_SQL = SCORE_SQL + """,
    nexts AS (SELECT traj_id, seq, CASE WHEN count(*) OVER (PARTITION BY traj_id) - seq <= 18
        THEN count(*) OVER (PARTITION BY traj_id) ELSE arg_max(seq, (score, -seq)) OVER (PARTITION BY traj_id ORDER BY seq
             ROWS BETWEEN 10 FOLLOWING AND 15 FOLLOWING) END AS nxt FROM scored),
    chain AS (SELECT traj_id, seq AS a, nxt FROM nexts WHERE seq = 0
              UNION ALL SELECT n.traj_id, n.seq, n.nxt FROM chain c JOIN nexts n ON n.traj_id = c.traj_id AND n.seq = c.nxt),
    steps AS (SELECT traj_id, row_number() OVER (PARTITION BY traj_id ORDER BY a) - 1 AS step_id, a AS first,
              nxt - 1 AS last FROM chain)"""


@query("boundary_score", f"WITH {SCORE_SQL} SELECT event_id, CAST(score AS DOUBLE) AS score FROM scored", using="traj")
def boundary_score(spark, sf):
    return P.boundary_scores(traj(spark, sf)).select("event_id", "score")


def numbered_once(spark, sf):
    """Trajectories numbered in blocks of about equal rows, written out as they are read more than once."""
    rows = even_blocks(traj_raw(spark, sf), ["traj_id"], "us", HOUR, 1 << 20)
    return cut_lineage(numbered(rows, ["traj_id"], ["us", "event_id"], F.col("_even")).drop("_even"))


def cut_steps(spark, sf, rows=None):
    return P.split_steps(P.boundary_scores(numbered_once(spark, sf) if rows is None else rows))


@query("split_steps", f"WITH RECURSIVE {SPLIT_SQL} SELECT traj_id, step_id, first, last FROM steps", using="traj")
def split_steps(spark, sf):
    return cut_steps(spark, sf).select("traj_id", "step_id", F.col("start").alias("first"), F.col("end").alias("last"))


@query("steps_to_actions", f"""WITH RECURSIVE {SPLIT_SQL}
    SELECT event_id, s.traj_id, step_id, first_value(value) OVER (PARTITION BY s.traj_id, step_id ORDER BY seq) AS at_start
    FROM steps s JOIN traj t ON t.traj_id = s.traj_id AND t.seq BETWEEN first AND last""", using="traj")
def steps_to_actions(spark, sf):
    rows = numbered_once(spark, sf)
    found = P.steps_to_actions(cut_steps(spark, sf, rows), rows)
    # A step is short by construction, so it fits a window.
    at_start = F.first("value").over(Window.partitionBy(*KEYS).orderBy("seq"))
    return found.select("event_id", *KEYS, at_start.alias("at_start"))


CUE_SQL = f"""SELECT {{keys}}, array_to_string([x FOR x IN [
        CASE WHEN bool_or(ability IN {quoted(WORKER_ACTIONS)}) THEN 'worker_saturation' END,
        CASE WHEN bool_or(ability = 'TERRANBUILD_SUPPLYDEPOT' OR ability IN {quoted(PRODUCTION_ACTIONS)})
              OR count(*) FILTER (regexp_matches(ability, '^(COMMANDCENTER|BARRACKS|FACTORY|STARPORT)?TRAIN_')) >= 4
             THEN 'supply_buffer' END,
        CASE WHEN bool_or(ability = 'TERRANBUILD_REFINERY') THEN 'gas_refinery'
             WHEN bool_or(ability IN {quoted(GAS_HEAVY_ACTIONS)}) THEN 'gas_heavy' END] IF x IS NOT NULL], ',') AS cues
    FROM {{rows}} GROUP BY {{keys}}"""


def cue_names(cues):
    """Short names of the cue sentences."""
    names = F.create_map(*[F.lit(x) for name, text in P.CUES.items() for x in (text, name)])
    return F.concat_ws(",", F.transform(cues, lambda c: names[c]))


@query("soft_cues", "SELECT traj_id, step_id, CASE WHEN cues = '' THEN 'macro_pacing' ELSE cues END AS cues FROM ("
       + CUE_SQL.format(keys="traj_id, step_id", rows="step") + ")", using="step")
def soft_cues(spark, sf):
    return P.soft_cues(step(spark, sf), KEYS).select(*KEYS, cue_names(F.col("cues")).alias("cues"))


@query("cue_lookup", "SELECT l_orderkey, l_linenumber, coalesce(cues, '') AS cues FROM lineitem LEFT JOIN ("
       + CUE_SQL.format(keys="traj_id, step_id", rows="step") + """) c
    ON l_orderkey % 200 = traj_id AND l_linenumber = step_id""", using="step")
def cue_lookup(spark, sf):
    cues = P.soft_cues(step(spark, sf), KEYS).select(*KEYS, F.regexp_replace(
        cue_names(F.col("cues")), "macro_pacing", "").alias("cues"))
    asked = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 200).alias("traj_id"),
        F.col("l_linenumber").cast("bigint").alias("step_id"))
    return asked.join(cues, KEYS, "left").select("l_orderkey", "l_linenumber", F.coalesce("cues", F.lit("")).alias("cues"))


@query("remaining_actions", """
    SELECT event_id, coalesce(string_agg(ability, ',') OVER (PARTITION BY traj_id, step_id ORDER BY seq
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS remaining FROM step""", using="step")
def remaining_actions(spark, sf):
    # A step has few actions by construction, so its rest fits one list.
    lists = step(spark, sf).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("seq", "ability", "event_id"))).alias("a"))
    rest = F.transform("a", lambda e, i: F.struct(e["event_id"].alias("event_id"), F.concat_ws(",", F.transform(
        F.slice("a", i + 2, F.size("a")), lambda x: x["ability"])).alias("remaining")))
    return lists.select(F.inline(rest))


@query("future_producers", f"""
    WITH {ACCEPTED} SELECT a.event_id, b.event_id AS later, c.alternative AS produces
    FROM step a JOIN accepted c USING (ability) JOIN ability m ON m.result = c.alternative
    JOIN step b ON b.traj_id = a.traj_id AND b.step_id = a.step_id AND b.ability = m.ability AND b.seq > a.seq""",
       using="step ability executor")
def future_producers(spark, sf):
    ability, executor = graph(spark, "ability"), graph(spark, "executor")
    makers = ability.select(F.col("ability").alias("maker"), F.col("result").alias("alternative"))
    wanted = A.accepted_entities(ability, executor).select("ability", "alternative").distinct().join(makers, "alternative")
    rows = step(spark, sf)
    later = rows.select(*KEYS, F.col("ability").alias("maker"), F.col("seq").alias("at"), F.col("event_id").alias("later"))
    found = rows.join(wanted, "ability").join(later, [*KEYS, "maker"]).filter(F.col("at") > F.col("seq"))
    return found.select("event_id", "later", F.col("alternative").alias("produces"))


def at_start(spark, sf):
    """Steps with the entities that a step starts from, growing with its number."""
    owned = [["CommandCenter", "SCV"], ["CommandCenter", "SCV", "SupplyDepot"],
             ["CommandCenter", "SCV", "SupplyDepot", "BarracksTechLab", "Factory"]]
    pick = F.element_at(F.array(*[text_array(o) for o in owned]), (F.col("step_id") % 3 + 1).cast("int"))
    return step(spark, sf).withColumn("entities", pick)


def all_facts(spark):
    ability, executor = graph(spark, "ability"), graph(spark, "executor")
    implied = values_frame(spark, ["entity", "implied"], implied_pairs(IMPLIED_ENTITIES))
    return P.ability_facts(ability, A.accepted_entities(ability, executor), implied, executor)


CLOSED = """closed(entity, implied) AS (SELECT entity, implied FROM implied
    UNION SELECT c.entity, i.implied FROM closed c JOIN implied i ON c.implied = i.entity)"""
FACTS_SQL = f"""{CLOSED}, {ACCEPTED},
    meets AS (SELECT ability, needs, alternative FROM accepted UNION
              SELECT ability, needs, entity FROM accepted JOIN closed ON alternative = implied),
    facts AS (SELECT a.ability, a.kind, a.result, a.needs,
        (SELECT list(alternative) FROM meets m WHERE m.ability = a.ability) AS meets,
        (SELECT list(alternative) FROM accepted c WHERE c.ability = a.ability) AS accepts,
        (SELECT list(unit ORDER BY unit) FROM executor e WHERE e.ability = a.ability AND unit <> 'TechLab') AS units
        FROM ability a)"""
REPLAY_SQL = FACTS_SQL + """,
    acts AS (SELECT traj_id, step_id, seq - step_id * 12 AS i, f.*, lead(result) OVER w AS nothing,
        list(result) OVER (PARTITION BY traj_id, step_id ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later
        FROM step JOIN facts f USING (ability) WINDOW w AS (PARTITION BY traj_id, step_id ORDER BY seq)),
    replay AS (
        SELECT traj_id, step_id, CAST(-1 AS BIGINT) AS i, '' AS ability, true AS available, '' AS missing, '' AS missing_executors,
            false AS order_issue, CASE step_id % 3 WHEN 0 THEN ['CommandCenter', 'SCV']
                WHEN 1 THEN ['CommandCenter', 'SCV', 'SupplyDepot']
                ELSE ['CommandCenter', 'SCV', 'SupplyDepot', 'BarracksTechLab', 'Factory'] END AS held
        FROM (SELECT DISTINCT traj_id, step_id FROM step)
        UNION ALL
        SELECT traj_id, step_id, i, ability, NOT lacks AND NOT nobody, CASE WHEN lacks THEN needs ELSE '' END,
            CASE WHEN nobody THEN array_to_string(units, ',') ELSE '' END,
            coalesce((lacks AND list_has_any(accepts, later)) OR (nobody AND list_has_any(units, later)), false),
            CASE WHEN lacks OR nobody THEN held ELSE list_distinct(list_concat(CASE WHEN kind = 'Morph'
                THEN [x FOR x IN held IF NOT list_contains(units, x)] ELSE held END,
                CASE WHEN result IS NULL THEN [] ELSE [result] END)) END
        FROM (SELECT a.*, r.held, a.needs IS NOT NULL AND NOT list_has_any(a.meets, r.held) AS lacks,
                     a.units IS NOT NULL AND NOT list_has_any(a.units, r.held) AS nobody
              FROM replay r JOIN acts a ON a.traj_id = r.traj_id AND a.step_id = r.step_id AND a.i = r.i + 1))"""


def replayed(spark, sf):
    return P.prereq_replay(at_start(spark, sf), KEYS, all_facts(spark))


@query("prereq_replay", f"""WITH RECURSIVE {REPLAY_SQL}
    SELECT traj_id, step_id, i AS index, ability, available, missing, missing_executors, order_issue FROM replay
    WHERE i >= 0""", using="step ability executor implied")
def prereq_replay(spark, sf):
    rows = replayed(spark, sf)
    return rows.select(*KEYS, "index", "ability", "available", F.concat_ws(",", "missing").alias("missing"),
                       F.concat_ws(",", "missing_executors").alias("missing_executors"), "order_issue")


@query("hint_lines", f"""WITH RECURSIVE {REPLAY_SQL}, present AS (SELECT DISTINCT traj_id, step_id, ability FROM step),
    rel AS (SELECT DISTINCT p.traj_id, p.step_id, p.ability AS action, q.ability AS depends_on, c.alternative AS via
        FROM present p JOIN accepted c ON p.ability = c.ability JOIN ability m ON m.result = c.alternative
        JOIN present q ON q.traj_id = p.traj_id AND q.step_id = p.step_id AND q.ability = m.ability
        WHERE p.ability <> q.ability),
    l AS (SELECT traj_id, step_id, 0 AS part, i, '  - ' || ability || ' still missing: ' || missing AS line FROM replay
          WHERE missing <> ''
          UNION ALL SELECT traj_id, step_id, 1, 0, '  - ' || action || ' requires ' || depends_on || ' first (via ' || via || ')'
          FROM rel)
    SELECT traj_id, step_id, string_agg(line, chr(10) ORDER BY part, i, line) AS hints FROM l GROUP BY ALL""",
       using="step ability executor implied")
def hint_lines(spark, sf):
    relations = A.step_prereqs(step(spark, sf), KEYS, graph(spark, "ability"), graph(spark, "executor"))
    return P.hint_lines(replayed(spark, sf), relations, KEYS)


@query("conflict_lines", f"""
    WITH {RESOURCES}, firsts AS (SELECT traj_id, step_id, ability, min(seq) AS f FROM step GROUP BY ALL),
    p AS (SELECT a.traj_id, a.step_id, a.f, b.f AS g, '  - ' || a.ability || ' and ' || b.ability || ' share producer(s): '
        || string_agg(DISTINCT ra.resource, ', ' ORDER BY ra.resource) AS line
        FROM firsts a JOIN firsts b ON a.traj_id = b.traj_id AND a.step_id = b.step_id AND a.f < b.f
        JOIN resources ra ON ra.ability = a.ability JOIN resources rb ON rb.ability = b.ability AND ra.resource = rb.resource
        GROUP BY a.traj_id, a.step_id, a.f, b.f, a.ability, b.ability)
    SELECT traj_id, step_id, string_agg(line, chr(10) ORDER BY line) AS hints FROM p GROUP BY ALL""",
       using="step ability executor")
def conflict_lines(spark, sf):
    resources = A.queue_resources(graph(spark, "ability"), graph(spark, "executor"))
    pairs = A.action_conflicts(step(spark, sf), KEYS, resources, "seq")
    line = F.concat(F.lit("  - "), "left_action", F.lit(" and "), "right_action", F.lit(" share producer(s): "),
                    F.concat_ws(", ", "shared"))
    return pairs.groupBy(*KEYS).agg(F.array_sort(F.collect_list(line)).alias("l")).select(
        *KEYS, F.concat_ws("\n", "l").alias("hints"))


@query("available_now", f"""
    WITH RECURSIVE {FACTS_SQL}, held AS (SELECT event_id, ability, CASE k % 3 WHEN 0 THEN ['CommandCenter', 'SCV']
        WHEN 1 THEN ['SCV', 'SupplyDepot', 'Barracks'] ELSE ['OrbitalCommand', 'FactoryTechLab'] END AS h FROM traj)
    SELECT event_id, (needs IS NULL OR list_has_any(meets, h)) AND (units IS NULL OR list_has_any(units, h)) AS available
    FROM held JOIN facts USING (ability)""", using="traj ability executor implied")
def available_now(spark, sf):
    rows = held_now(spark, sf).join(all_facts(spark), "ability", "left")
    lacking = F.exists("facts.reqs", lambda r: ~F.arrays_overlap(r["meets"], F.col("held")))
    nobody = (F.size("facts.executors") > 0) & ~F.arrays_overlap("facts.executors", "held")
    return rows.select("event_id", (F.col("facts").isNotNull() & ~lacking & ~nobody).alias("available"))


def held_now(spark, sf):
    owned = [["CommandCenter", "SCV"], ["SCV", "SupplyDepot", "Barracks"], ["OrbitalCommand", "FactoryTechLab"]]
    pick = F.element_at(F.array(*[text_array(o) for o in owned]), (F.col("k") % 3 + 1).cast("int"))
    return traj_raw(spark, sf).withColumn("held", pick)


@query("gap_fill", f"""
    WITH RECURSIVE {FACTS_SQL}, held AS (SELECT event_id, ability, CASE k % 3 WHEN 0 THEN ['CommandCenter', 'SCV']
        WHEN 1 THEN ['SCV', 'SupplyDepot', 'Barracks'] ELSE ['OrbitalCommand', 'FactoryTechLab'] END AS h,
        CASE WHEN k % 4 = 0 THEN ['Factory', 'Barracks'] ELSE ['SCV'] END AS coming FROM traj),
    m AS (SELECT event_id, coming, CASE WHEN needs IS NOT NULL AND NOT list_has_any(meets, h) THEN [needs] ELSE [] END
            || CASE WHEN units IS NOT NULL AND NOT list_has_any(units, h) THEN units ELSE [] END AS missing
          FROM held JOIN facts USING (ability)),
    e AS (SELECT event_id, unnest(missing) AS entity, generate_subscripts(missing, 1) AS i, coming FROM m),
    best AS (SELECT result AS entity, arg_min(ability, (CASE WHEN regexp_matches(kind, '^(Build|Train|Research)') THEN '0'
                 ELSE '1' END) || ability) AS fill FROM ability
             WHERE ability IN (SELECT ability FROM executor WHERE race = 'Terran') AND result IS NOT NULL GROUP BY result),
    f AS (SELECT event_id, fill, min(i) AS i FROM e JOIN best USING (entity) WHERE NOT list_contains(coming, entity)
          GROUP BY ALL)
    SELECT event_id, string_agg(fill, ',' ORDER BY i) AS fills FROM f GROUP BY event_id""",
       using="traj ability executor implied")
def gap_fill(spark, sf):
    rows = held_now(spark, sf).join(all_facts(spark), "ability")
    coming = F.when(F.col("k") % 4 == 0, text_array(["Factory", "Barracks"])).otherwise(text_array(["SCV"]))
    ability, executor = graph(spark, "ability"), graph(spark, "executor").filter(F.col("race") == "Terran")
    return A.gap_fill(rows.withColumn("coming", coming), ability, executor, "event_id").select(
        "event_id", F.concat_ws(",", "fills").alias("fills"))


@query("entity_closure", f"""
    WITH RECURSIVE {CLOSED}, held AS (SELECT DISTINCT traj_id, (['OrbitalCommandFlying', 'VikingAssault', 'FactoryReactor',
        'Marine', 'SupplyDepotLowered'])[k % 5 + 1] AS entity FROM traj)
    SELECT traj_id, string_agg(entity, ',' ORDER BY entity) AS entities FROM (
        SELECT traj_id, entity FROM held UNION SELECT traj_id, c.implied FROM held JOIN closed c USING (entity))
    GROUP BY traj_id""", using="traj implied")
def entity_closure(spark, sf):
    names = text_array(["OrbitalCommandFlying", "VikingAssault", "FactoryReactor", "Marine", "SupplyDepotLowered"])
    rows = traj_raw(spark, sf).withColumn("entity", F.element_at(names, (F.col("k") % 5 + 1).cast("int")))
    closed = held_with(rows, "traj_id", values_frame(spark, ["entity", "implied"], implied_pairs(IMPLIED_ENTITIES)))
    return closed.groupBy("traj_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("entity"))).alias("entities"))


@query("completed_entities", """
    WITH c AS (SELECT traj_id, ['SUPPLY_DEPOT', 'BARRACKS', 'ORBITAL COMMAND', 'MARINE', 'SIEGE_TANK'][k % 5 + 1] AS raw,
        count(*) - 14 AS n FROM traj GROUP BY ALL),
    u AS (SELECT DISTINCT traj_id, 'Up' || event_type AS raw FROM traj WHERE value > 150),
    n AS (SELECT traj_id, CASE raw WHEN 'SUPPLY_DEPOT' THEN 'SupplyDepot' WHEN 'BARRACKS' THEN 'Barracks'
        WHEN 'ORBITAL COMMAND' THEN 'OrbitalCommand' WHEN 'MARINE' THEN 'Marine' ELSE 'SiegeTank' END AS name
        FROM c WHERE n > 0 UNION SELECT traj_id, raw FROM u)
    SELECT t.traj_id, coalesce(string_agg(name, ',' ORDER BY name), '') AS entities
    FROM (SELECT DISTINCT traj_id FROM traj) t LEFT JOIN n USING (traj_id) GROUP BY t.traj_id""", using="traj")
def completed_entities(spark, sf):
    names = text_array(["SUPPLY_DEPOT", "BARRACKS", "ORBITAL COMMAND", "MARINE", "SIEGE_TANK"])
    rows = traj_raw(spark, sf).withColumn("raw", F.element_at(names, (F.col("k") % 5 + 1).cast("int")))
    counts = rows.groupBy("traj_id", "raw").agg((F.count(F.lit(1)) - 14).alias("n")).groupBy("traj_id").agg(
        F.map_from_entries(F.collect_list(F.struct("raw", "n"))).alias("counts"))
    upgrades = rows.groupBy("traj_id").agg(F.collect_set(F.when(
        F.col("value") > 150, F.concat(F.lit("Up"), "event_type"))).alias("upgrades"))
    entities = P.completed_entities(F.col("counts"), F.col("upgrades"))
    return counts.join(upgrades, "traj_id").select("traj_id", F.concat_ws(",", entities).alias("entities"))


@query("forbidden_actions", """
    WITH r AS (SELECT traj_id, (['LIFT_BARRACKS', 'LAND_FACTORY', 'MOVE_MOVE', 'BARRACKSTRAIN_MARINE'])[k % 4 + 1] AS a,
               value FROM traj)
    SELECT traj_id, string_agg(DISTINCT a, ',' ORDER BY a) AS forbidden FROM r
    WHERE value > 120 AND (contains(a, 'LIFT') OR contains(a, 'LAND')) GROUP BY traj_id""", using="traj")
def forbidden_actions(spark, sf):
    names = text_array(["LIFT_BARRACKS", "LAND_FACTORY", "MOVE_MOVE", "BARRACKSTRAIN_MARINE"])
    rows = traj_raw(spark, sf).withColumn("a", F.element_at(names, (F.col("k") % 4 + 1).cast("int")))
    found = rows.filter((F.col("value") > 120) & F.rlike("a", F.lit("LIFT|LAND")))
    return found.groupBy("traj_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("a"))).alias("forbidden"))


@query("first_index_order", """
    SELECT traj_id, min(seq) FILTER (ability = 'TERRANBUILD_BARRACKS') < min(seq) FILTER (ability = 'TERRANBUILD_FACTORY')
        AS in_order FROM traj GROUP BY traj_id""", using="traj")
def first_index_order(spark, sf):
    # The first position of each action is enough, and (us, event_id) is the order of positions.
    at = F.struct("us", "event_id")

    def first(name):
        return F.min(F.when(F.col("ability") == name, at))

    return traj_raw(spark, sf).groupBy("traj_id").agg(
        (first("TERRANBUILD_BARRACKS") < first("TERRANBUILD_FACTORY")).alias("in_order"))


@query("action_table", """
    WITH w AS (SELECT CAST(max(length(ability)) AS INTEGER) AS n FROM ability)
    SELECT event_id, rpad(traj.ability, n, ' ') || '  ' || rpad(coalesce(result, CASE WHEN contains(traj.ability, '_') AND upper(split_part(traj.ability, '_', -1)) = split_part(traj.ability, '_', -1) THEN split_part(traj.ability, '_', -1) END, '(no product)'), 28, ' ') || ' '
        || rpad(coalesce(type, '-'), 8, ' ') || ' ' || lpad(CASE WHEN coalesce(minerals, 0) + coalesce(gas, 0) > 0
            THEN minerals || '/' || gas ELSE '-' END, 14, ' ') || ' ' || rpad(coalesce(needs, '-'), 20, ' ') AS line
    FROM traj JOIN ability USING (ability) LEFT JOIN entity ON result = name, w""",
       using="traj ability entity")
def action_table(spark, sf):
    ability, entity = graph(spark, "ability"), graph(spark, "entity")
    facts = ability.join(entity, F.col("result") == F.col("name"), "left").select(
        "ability", "result", F.col("needs").alias("requires"), "type", "minerals", "gas")
    return A.action_table(traj_raw(spark, sf), facts).select("event_id", "line")


@query("build_order_script", """
    WITH r AS (SELECT traj_id, us, event_id, seq, ability, CASE WHEN kind IN ('Build', 'Train', 'Research') THEN result
                   ELSE '' END AS unit, kind FROM traj JOIN ability USING (ability)),
    c AS (SELECT *, row_number() OVER (PARTITION BY traj_id, unit ORDER BY us, event_id)
              + CASE unit WHEN 'SCV' THEN 12 WHEN 'CommandCenter' THEN 1 ELSE 0 END AS n,
              lead(unit) OVER (PARTITION BY traj_id ORDER BY us, event_id) AS nxt FROM r)
    SELECT event_id, CASE WHEN unit = '' THEN '# ' || ability WHEN kind = 'Research' THEN 'Tech(' || unit || ')'
        ELSE 'BuildId(' || unit || ', to_count=' || n || ')' END AS line,
        CAST(floor(((us - 1704067200000000) / 1e6) / 22.4) AS BIGINT) AS seconds
    FROM c WHERE nxt IS NULL OR unit = '' OR nxt <> unit""", using="traj ability")
def build_order_script(spark, sf):
    rows = traj_raw(spark, sf).join(graph(spark, "ability"), "ability")
    unit = F.when(F.col("kind").isin("Build", "Train", "Research"), F.col("result")).otherwise("")
    rows = rows.select("traj_id", "us", "event_id", "kind", unit.alias("unit"), F.col("ability").alias("action"),
                       ((F.col("us") - 1704067200000000) / 1e6).alias("frame"))
    return P.build_order(rows, "traj_id", ["us", "event_id"], hour_of()).select("event_id", "line", "seconds")


# Race, rank, telling structure, unit, most, minerals, gas.
RULE_COLUMNS = ["race", "rank", "structure", "unit", "most", "minerals", "gas"]
RULES = [
    ("Zerg", 0, None, "ROACH", 1, 75, 25),
    ("Zerg", 1, "GREATERSPIRE", "BROODLORD", 5, 150, 150),
    ("Zerg", 2, "GREATERSPIRE", "CORRUPTOR", 5, 150, 100),
    ("Zerg", 3, "SPIRE", "MUTALISK", 6, 100, 100),
    ("Zerg", 4, "ROACHWARREN", "ROACH", 10, 75, 25),
    ("Zerg", 5, "SPAWNINGPOOL", "ZERGLING", 4, 25, 0),
    ("Protoss", 0, "FLEETBEACON", "TEMPEST", 3, 250, 175),
    ("Protoss", 1, "DARKSHRINE", "DARKTEMPLAR", 4, 125, 125),
    ("Protoss", 2, "TEMPLARARCHIVE", "HIGHTEMPLAR", 4, 50, 150),
    ("Protoss", 3, "ROBOTICSBAY", "COLOSSUS", 2, 300, 200),
    ("Protoss", 4, "ROBOTICSFACILITY", "IMMORTAL", 4, 275, 100),
    ("Terran", 0, None, "MARAUDER", 1, 100, 25),
    ("Terran", 1, "FUSIONCORE", "BATTLECRUISER", 3, 400, 300),
    ("Terran", 2, "GHOSTACADEMY", "GHOST", 5, 150, 125),
    ("Terran", 3, "STARPORTREACTOR", "VIKINGFIGHTER", 4, 150, 75),
    ("Terran", 4, "FACTORYTECHLAB", "SIEGETANK", 4, 150, 125),
    ("Terran", 5, "BARRACKSREACTOR", "MARINE", 10, 50, 0),
]
SEEN = ["FUSIONCORE", "SPIRE", "DARKSHRINE", "BARRACKSREACTOR", "ROACHWARREN", "ROBOTICSBAY", "SPAWNINGPOOL",
        "FACTORYTECHLAB", "FLEETBEACON", "GREATERSPIRE"]


@query("predict_composition", f"""
    WITH RECURSIVE rules AS ({values_sql(RULE_COLUMNS, RULES)}),
    g AS (SELECT traj_id, us // 86400000000 AS day, (['Terran', 'Zerg', 'Protoss'])[traj_id % 3 + 1] AS race,
          list(DISTINCT ({sql_list(SEEN)})[k % {len(SEEN)} + 1]) AS seen, CAST(sum(k) * 10 AS DOUBLE) AS m0,
          CAST(sum(k) * 6 AS DOUBLE) AS g0 FROM traj GROUP BY ALL),
    walk AS (SELECT traj_id, day, race, seen, m0 AS m, g0 AS gas_left, CAST(-1 AS BIGINT) AS rank, CAST(NULL AS VARCHAR) AS unit,
             false AS allowed, CAST(0 AS BIGINT) AS n FROM g
        UNION ALL SELECT traj_id, day, race, seen, m - n * minerals, gas_left - n * gas, rank, unit, allowed, n FROM (
            SELECT w.traj_id, w.day, w.race, w.seen, w.m, w.gas_left, CAST(r.rank AS BIGINT) AS rank, r.unit, r.minerals, r.gas,
                r.structure IS NULL OR list_contains(w.seen, r.structure) AS allowed,
                CASE WHEN r.structure IS NULL OR list_contains(w.seen, r.structure) THEN CAST(greatest(0, floor(least(r.most,
                    CASE WHEN r.minerals > 0 THEN w.m / r.minerals ELSE 100 END,
                    CASE WHEN r.gas > 0 THEN w.gas_left / r.gas ELSE 100 END))) AS BIGINT) ELSE 0 END AS n
            FROM walk w JOIN rules r ON r.race = w.race AND r.rank = w.rank + 1))
    SELECT traj_id, day, rank, unit, n AS count FROM walk WHERE allowed""", using="traj")
def predict_composition(spark, sf):
    races = text_array(["Terran", "Zerg", "Protoss"])
    rows = traj_raw(spark, sf).withColumn("day", F.floor(F.col("us") / 86_400_000_000))
    seen = F.element_at(text_array(SEEN), (F.col("k") % len(SEEN) + 1).cast("int"))
    games = rows.groupBy("traj_id", "day").agg(
        F.collect_set(seen).alias("structures"), (F.sum("k") * 10).alias("minerals"), (F.sum("k") * 6).alias("gas"))
    games = games.withColumn("race", F.element_at(races, (F.col("traj_id") % 3 + 1).cast("int")))
    return P.predict_composition(games, ["traj_id", "day"], values_frame(spark, RULE_COLUMNS, RULES))


@query("deterministic_shuffle", """
    WITH s AS (SELECT traj_id, step_id, list(ability ORDER BY seq) AS a FROM step GROUP BY ALL),
    t AS (SELECT traj_id, step_id, a, n, list(x ORDER BY sha256(traj_id || '/' || step_id || ':0:' || n || ':' || (i - 1)), x) AS o
          FROM (SELECT traj_id, step_id, a, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM s),
               (SELECT unnest(range(8)) AS n) GROUP BY traj_id, step_id, a, n)
    SELECT traj_id, step_id, array_to_string(coalesce(arg_min(o, n) FILTER (o <> a), any_value(a)), ',') AS shuffled
    FROM t GROUP BY traj_id, step_id""", using="step")
def deterministic_shuffle(spark, sf):
    lists = step_lists(spark, sf)
    order = P.shuffled(F.col("actions"), F.concat_ws("/", *KEYS), F.lit(0))
    return lists.select(*KEYS, F.concat_ws(",", order).alias("shuffled"))


def step_lists(spark, sf):
    lists = step(spark, sf).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("seq", "ability"))).alias("a"))
    return lists.select(*KEYS, F.transform("a", lambda e: e["ability"]).alias("actions"))
