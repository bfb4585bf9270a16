"""Sources, sinks, set operations and the relations of the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.operators import sets as S
from stepforge.operators.keyed import first_per_key
from stepforge.plans import graph as G
from stepforge.sources import files as IO
from stepforge.workload.graph_rows import graph
from stepforge.workload.registry import query
from stepforge.workload.views import match, pos, sample, step, table, traj_raw


@query("scan_trajectories", """
    SELECT traj_id || '/' || step_id AS game, count(*) AS actions, count(*) FILTER (value > 100) AS with_text,
        min(ability) AS least FROM step GROUP BY traj_id, step_id HAVING count(*) > 3""", using="step")
def scan_trajectories(spark, sf):
    # Steps are written as compacted trajectories, short ones without an order list, and read back.
    empty = F.array().cast("array<string>")
    obs = F.struct(F.struct(F.lit("x").alias("structured"), F.when(F.col("value") > 100, "seen").alias("text")).alias("o"))
    act = F.struct("seq", "ability", obs["o"].alias("obs"))
    games = step(spark, sf).groupBy("traj_id", "step_id").agg(F.array_sort(F.collect_list(act)).alias("sequence"))
    names = F.transform("sequence", lambda a: a["ability"])
    rows = games.select(
        F.struct(F.concat_ws("/", "traj_id", "step_id").alias("opponent_id"), F.lit("Victory").alias("result")).alias("meta"),
        "sequence", F.when(F.size("sequence") > 3, names).otherwise(empty).alias("order_list"))
    folder = IO.run_folder(spark, "trajectories")
    IO.write_dataset(rows, folder)
    found = IO.actions_of(IO.read_trajectories(spark, folder, per_file=False), ["path"])
    return found.groupBy(F.col("meta.opponent_id").alias("game")).agg(
        F.count(F.lit(1)).alias("actions"), F.count_if(F.coalesce(F.col("obs.text") == "seen", F.lit(False))).alias("with_text"),
        F.min("ability").alias("least"))


@query("scan_jsonl", "SELECT conv_id, turn, role, length(text) AS n FROM conversations")
def scan_jsonl(spark, sf):
    folder = IO.run_folder(spark, "jsonl")
    IO.write_dataset(table(spark, sf, "conversations"), folder)
    rows = IO.read_jsonl(spark, folder, "conv_id bigint, turn bigint, role string, text string")
    return rows.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("n"))


@query("scan_qa_payload", """
    SELECT CASE WHEN value <= 100 OR value > 200 THEN event_type ELSE '' END AS strategy, count(*) AS records
    FROM events GROUP BY 1""")
def scan_qa_payload(spark, sf):
    # One payload per event keeps lists short; both shapes of payload occur.
    named = F.col("value") > 200
    record = F.struct(F.col("event_id").alias("id"), F.when(named, F.col("event_type")).alias("strategy"))
    wide = F.col("value") <= 100
    payload = table(spark, sf, "events").select(
        F.when(wide, F.create_map("event_type", F.array(record))).alias("by_strategy"),
        F.when(~wide, F.array(record)).alias("records"))
    return IO.strategy_records(payload).groupBy("strategy").agg(F.count(F.lit(1)).alias("records"))


@query("scan_laststep_qa", """
    SELECT conv_id, system, user_text FROM sample WHERE turns >= 4 AND user_text IS NOT NULL""", using="sample")
def scan_laststep_qa(spark, sf):
    message = lambda role, column: F.struct(F.lit(role).alias("role"), F.col(column).alias("content"))
    rows = sample(spark, sf).select(
        "conv_id", F.when(F.col("turns") >= 4, "naming").otherwise("other").alias("agent"),
        F.filter(F.array(message("system", "system"), message("user", "user")), lambda m: m["content"].isNotNull()).alias("prompt"))
    rows = rows.filter(F.col("agent") == "naming")
    pulled = rows.select("conv_id", X.turn_value(F.col("prompt"), "system", "role", "content").alias("system"),
                         X.turn_value(F.col("prompt"), "user", "role", "content").alias("user_text"))
    return pulled.filter(F.col("user_text").isNotNull())


@query("scan_matches", "SELECT bot, difficulty, count(*) AS n, count(*) FILTER (victory) AS wins FROM match GROUP BY ALL",
       using="match")
def scan_matches(spark, sf):
    # Runs of at most 32 matches are written as result files and read back.
    folder = IO.run_folder(spark, "matches")
    entry = F.struct(F.col("bot").alias("bot_key"), "difficulty", F.col("race").alias("enemy_race"), "victory")
    match(spark, sf).groupBy("bot", F.floor(F.col("match_id") / 32)).agg(F.collect_list(entry).alias("matches")).select("matches").write.json(folder)
    rows = IO.read_matches(spark, folder, "*.json", lines=True)
    return rows.groupBy(F.col("bot_key").alias("bot"), "difficulty").agg(F.count(F.lit(1)).alias("n"), F.count_if("victory").alias("wins"))


@query("write_dataset", "SELECT doc_id, lang, n_chars FROM documents")
def write_dataset(spark, sf):
    folder = IO.run_folder(spark, "dataset")
    rows = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    IO.write_dataset(rows.filter(F.col("lang") == "en"), folder, form="parquet")
    IO.write_dataset(rows.filter(F.col("lang") != "en"), folder, append=True, form="parquet")
    return spark.read.schema(rows.schema).parquet(folder)


@query("write_manifest", "SELECT count(*) AS rows, count(DISTINCT lang) AS langs, 'naming' AS task FROM documents")
def write_manifest(spark, sf):
    folder = IO.run_folder(spark, "manifest")
    IO.write_manifest(table(spark, sf, "documents"), folder, {
        "rows": F.count(F.lit(1)), "langs": F.countDistinct("lang")}, {"task": "naming"})
    schema = "rows bigint, langs bigint, parameters struct<task:string>"
    return IO.read_jsonl(spark, folder, schema).select("rows", "langs", F.col("parameters.task").alias("task"))


@query("dataset_registry", """
    SELECT DISTINCT 'sc2_' || CASE role WHEN 'user' THEN 'naming' WHEN 'assistant' THEN 'ordering' ELSE 'executor' END
        || '_qwen3_' || m || '_sft' AS name, 'sharegpt' AS formatting, 'conversations' AS messages, 'human' AS user_tag
    FROM conversations, (SELECT unnest(['thinking', 'nothink']) AS m)""")
def dataset_registry(spark, sf):
    # The datasets present in the data: tasks stand for the roles that occur.
    task = F.when(F.col("role") == "user", "naming").when(F.col("role") == "assistant", "ordering").otherwise("executor")
    modes = F.explode(F.array(*[F.lit(m) for m in IO.MODES]))
    present = table(spark, sf, "conversations").select(task.alias("task")).distinct().select("task", modes.alias("mode"))
    return IO.dataset_registry(present).select(
        "name", "formatting", F.col("columns.messages").alias("messages"), F.col("tags.user_tag").alias("user_tag"))


@query("merge_existing", """
    SELECT o_orderkey, o_custkey, 'new' AS version FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    UNION ALL SELECT o_orderkey, o_custkey, 'old' FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
        AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')""")
def merge_existing(spark, sf):
    orders = table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    old = orders.filter(~late).select("o_orderkey", "o_custkey", F.lit("old").alias("version"))
    new = orders.filter(late).select("o_orderkey", "o_custkey", F.lit("new").alias("version"))
    return IO.merge_existing(old, new, "o_custkey")


@query("history_upsert", """
    WITH r AS (SELECT user_id AS enemy, k AS guid, event_id, value, ts FROM (SELECT *,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))
    SELECT enemy, guid, arg_max(event_id, (ts, event_id)) AS event_id FROM r GROUP BY enemy, guid""")
def history_upsert(spark, sf):
    # Every result of a guid replaces the earlier one and moves to the end: the latest row per guid is left.
    rows = traj_raw(spark, sf).select(F.col("traj_id").alias("enemy"), F.col("k").alias("guid"), "event_id", "us")
    return first_per_key(rows, ["enemy", "guid"], [F.col("us"), F.col("event_id")], latest=True).select(
        "enemy", "guid", "event_id")


@query("history_merge", """
    WITH o AS (SELECT o_custkey AS enemy, o_orderkey AS guid, o_totalprice AS duration FROM orders),
    n AS (SELECT o_custkey AS enemy, o_orderkey AS guid, 0.0 AS duration FROM orders WHERE o_orderstatus = 'P')
    SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.guid = o.guid AND n.enemy = o.enemy)
    UNION ALL SELECT * FROM n""")
def history_merge(spark, sf):
    orders = table(spark, sf, "orders")
    history = orders.select(F.col("o_custkey").alias("enemy"), F.col("o_orderkey").alias("guid"),
                            F.col("o_totalprice").alias("duration"))
    results = history.join(orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("guid")), "guid", "left_semi")
    results = results.select("enemy", "guid", F.lit(0.0).alias("duration"))
    return S.union_by_tag(results, history, "guid")


@query("union_by_tag", """
    WITH a AS (SELECT tag, type FROM pos WHERE size > 20), b AS (SELECT tag, type FROM pos WHERE size < 30)
    SELECT * FROM a UNION ALL SELECT * FROM b WHERE tag NOT IN (SELECT tag FROM a)""", using="pos")
def union_by_tag(spark, sf):
    rows = pos(spark, sf).select("tag", "type", "size")
    return S.union_by_tag(rows.filter("size > 20"), rows.filter("size < 30"), "tag").select("tag", "type")


@query("intersect_by_tag", "SELECT tag, type FROM pos WHERE size > 20 AND size < 30", using="pos")
def intersect_by_tag(spark, sf):
    rows = pos(spark, sf).select("tag", "type", "size")
    return S.intersect_by_tag(rows.filter("size > 20"), rows.filter("size < 30"), "tag").select("tag", "type")


@query("except_by_tag", "SELECT tag, type FROM pos WHERE size >= 30", using="pos")
def except_by_tag(spark, sf):
    rows = pos(spark, sf).select("tag", "type", "size")
    return S.except_by_tag(rows.filter("size > 20"), rows.filter("size < 30"), "tag").select("tag", "type")


EDGES_SQL = """used AS (SELECT ability, count(*) AS n FROM traj GROUP BY ability),
    has AS (SELECT unit AS subject, ability AS object FROM executor),
    reqs AS (SELECT ability AS subject, needs AS object FROM ability WHERE needs IS NOT NULL)"""


def used(spark, sf):
    return traj_raw(spark, sf).groupBy("ability").agg(F.count(F.lit(1)).alias("n"))


def edge_query(name, body):
    return query(name, f"WITH {EDGES_SQL} {body}", using="traj ability executor entity")


@edge_query("derive_has_ability", "SELECT subject, 'has_ability' AS relation, object, n FROM has JOIN used ON object = ability")
def derive_has_ability(spark, sf):
    edges = G.has_ability(graph(spark, "executor"))
    return edges.join(used(spark, sf), F.col("object") == F.col("ability")).drop("ability")


@edge_query("derive_requires", """
    SELECT subject, 'ability_requires_' || CASE type WHEN 'Upgrade' THEN 'upgrade' ELSE 'unit' END AS relation, object, n
    FROM reqs LEFT JOIN entity ON object = name JOIN used ON subject = ability""")
def derive_requires(spark, sf):
    edges = G.requires(graph(spark, "ability"), graph(spark, "entity"))
    return edges.join(used(spark, sf), F.col("subject") == F.col("ability")).drop("ability")


@edge_query("derive_produces", """
    SELECT unit AS subject, CASE kind WHEN 'Research' THEN 'researches' ELSE 'produces' END AS relation, result AS object, n
    FROM executor JOIN ability a USING (ability) JOIN used USING (ability)
    WHERE kind IN ('Build', 'BuildOnUnit', 'BuildInstant', 'Train', 'Research')""")
def derive_produces(spark, sf):
    return G.produces(graph(spark, "executor"), graph(spark, "ability")).join(used(spark, sf), "ability").drop("ability")


@edge_query("derive_unlocks", """
    SELECT needs AS subject, 'unlocks' AS relation, ability AS object, n FROM ability JOIN used USING (ability)
    WHERE needs IS NOT NULL""")
def derive_unlocks(spark, sf):
    edges = G.unlocks(graph(spark, "ability"))
    return edges.join(used(spark, sf), F.col("object") == F.col("ability")).drop("ability")


@edge_query("derive_morph_spawn", """
    SELECT unit AS subject, CASE WHEN kind = 'Morph' THEN 'morphs_to' ELSE 'spawns' END AS relation, result AS object, n
    FROM executor JOIN ability a USING (ability) JOIN used USING (ability) WHERE kind IN ('Morph', 'MorphPlace', 'Train')""")
def derive_morph_spawn(spark, sf):
    return G.morph_spawn(graph(spark, "executor"), graph(spark, "ability")).join(used(spark, sf), "ability").drop("ability")


@edge_query("derive_action_result", """
    SELECT ability AS subject, 'action_result' AS relation, result AS object, n FROM ability JOIN used USING (ability)
    WHERE result IS NOT NULL""")
def derive_action_result(spark, sf):
    edges = G.action_result(graph(spark, "ability"))
    return edges.join(used(spark, sf), F.col("subject") == F.col("ability")).drop("ability")


@query("graph_edges", """
    SELECT event_id, 'action_result' AS relation, result AS object FROM traj JOIN ability USING (ability) WHERE result IS NOT NULL
    UNION ALL SELECT event_id, 'ability_requires_unit', needs FROM traj JOIN ability USING (ability) WHERE needs IS NOT NULL""",
       using="traj ability")
def graph_edges(spark, sf):
    # Edges come out of the nested relations of the ability rows, as they lie in the graph file.
    item = lambda relation, column: F.when(F.col(column).isNotNull(), F.struct(
        F.lit(relation).alias("relation"), F.col(column).alias("object_name")))
    nested = graph(spark, "ability").select("ability", F.array_compact(F.array(
        item("action_result", "result"), item("ability_requires_unit", "needs"))).alias("relations"))
    edges = nested.select("ability", F.explode_outer("relations").alias("r")).filter(F.col("r").isNotNull())
    return traj_raw(spark, sf).join(edges, "ability").select("event_id", "r.relation", F.col("r.object_name").alias("object"))


def graph_file(spark):
    """The graph written as one file of nested tables."""
    folder = IO.run_folder(spark, "graph")
    product = F.struct(F.when(F.col("kind") != "Research", F.col("result")).alias("produces_name"),
                       F.when(F.col("kind") == "Research", F.col("result")).alias("upgrade_name"))
    link = F.when(F.col("result").isNotNull(), F.struct(F.lit("action_result").alias("relation"), F.col("result").alias("object_name")))
    abilities = graph(spark, "ability").agg(F.collect_list(F.struct(
        F.col("ability").alias("name"), F.when(F.col("kind").isNotNull(), F.create_map(F.coalesce("kind", F.lit("")), product)).alias("target"), F.array_compact(F.array(link)).alias("relations"))).alias("Ability"))

    def listed(kind):
        return F.collect_list(F.when(F.col("type") == kind, F.struct("name", "race"))).alias(kind)

    # Both are single rows of fixed tables.
    entities = graph(spark, "entity").agg(listed("Unit"), listed("Upgrade"))
    abilities.withColumn("one", F.lit(1)).join(entities.withColumn("one", F.lit(1)), "one").drop("one").write.json(folder)
    return folder


@query("scan_graph", """
    SELECT e.type AS subject_table, e.race, count(*) AS uses, count(DISTINCT name) AS names
    FROM traj JOIN ability USING (ability) JOIN entity e ON result = name GROUP BY ALL""", using="traj ability entity")
def scan_graph(spark, sf):
    tables = IO.read_graph(spark, graph_file(spark))
    made = tables["Ability"].select(F.col("name").alias("ability"), "result")
    kinds = [tables[t].select(F.col("name").alias("result"), "race", F.lit(t).alias("subject_table")) for t in ("Unit", "Upgrade")]
    rows = traj_raw(spark, sf).join(made, "ability").join(kinds[0].unionByName(kinds[1]), "result")
    return rows.groupBy("subject_table", "race").agg(F.count(F.lit(1)).alias("uses"), F.countDistinct("result").alias("names"))


@query("ontology_check", """
    WITH e AS (SELECT l_returnflag AS relation, p_type AS subject_kind, p_brand AS object_kind FROM lineitem JOIN part
               ON l_partkey = p_partkey)
    SELECT relation, subject_kind, object_kind, count(*) AS violations FROM e
    WHERE NOT ((relation = 'A' AND subject_kind = 'SMALL') OR (relation = 'N' AND subject_kind IN ('LARGE', 'PROMO')))
        AND NOT (relation = 'R' AND object_kind = 'Brand#3') GROUP BY ALL""")
def ontology_check(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("subject_kind"),
                                            F.col("p_brand").alias("object_kind"))
    edges = table(spark, sf, "lineitem").select("l_partkey", F.col("l_returnflag").alias("relation")).join(parts, "l_partkey")
    # Edges are counted per kind before the rules are looked up.
    counted = edges.groupBy("relation", "subject_kind", "object_kind").agg(F.count(F.lit(1)).alias("violations"))
    allowed = [("A", "SMALL"), ("N", "LARGE"), ("N", "PROMO")]
    return G.violations(counted, allowed, {"R": ["Brand#3"]})


@query("edge_dedupe", """
    SELECT DISTINCT l_partkey AS subject, l_returnflag AS relation, l_suppkey AS object FROM lineitem
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def edge_dedupe(spark, sf):
    edges = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("subject"), F.col("l_returnflag").alias("relation"), F.col("l_suppkey").alias("object"))
    return G.dedupe_edges(edges, table(spark, sf, "part").select(F.col("p_partkey").alias("subject")),
                          table(spark, sf, "supplier").select(F.col("s_suppkey").alias("object")))


@query("coverage_summary", """
    SELECT p_type AS kind, count(*) AS entities, count(*) FILTER (p_size > 25) AS with_chain,
        count(*) FILTER (p_retailprice > 1000) AS with_description, count(*) FILTER (p_brand <> 'Brand#1') AS with_relations
    FROM part GROUP BY ROLLUP (p_type)""")
def coverage_summary(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_type").alias("kind"), (F.col("p_size") > 25).alias("chain"),
        (F.col("p_retailprice") > 1000).alias("description"), (F.col("p_brand") != "Brand#1").alias("relations"))
    return G.coverage(rows, "kind")
