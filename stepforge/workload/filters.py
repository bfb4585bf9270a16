"""Filters, keys and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.operators import filters as P
from stepforge.operators import picking as K
from stepforge.operators import listing as L
from stepforge.operators import sets as S
from stepforge.workload.aggregations import CLASSED_ITEMS, order_items
from stepforge.workload.graph_rows import graph, values_frame
from stepforge.workload.registry import query
from stepforge.workload.views import cand, match, pos, sample, table, text_array, traj_raw, units


@query("victory_filter", "SELECT match_id, bot FROM match WHERE victory AND duration > 1000", using="match")
def victory_filter(spark, sf):
    won = P.victories(match(spark, sf), F.col("victory"), F.col("duration") > 1000)
    return won.select("match_id", "bot")


@query("victory_filter_off", "SELECT match_id, bot FROM match WHERE duration > 1000", using="match")
def victory_filter_off(spark, sf):
    every = P.victories(match(spark, sf), F.col("victory"), F.col("duration") > 1000, on=False)
    return every.select("match_id", "bot")


@query("map_filter", """
    SELECT page_id FROM pages WHERE regexp_extract(url, '//([^/]+)', 1) = 'ththre.example.com'
        OR list_contains(string_split(url, '/'), 'fr')""")
def map_filter(spark, sf):
    host = F.regexp_extract("url", "//([^/]+)", 1)
    rows = table(spark, sf, "pages").select("page_id", F.when(host == "ththre.example.com", "fr").otherwise(host).alias("m"), "url")
    return P.on_map(rows, F.col("m"), F.col("url"), "fr").select("page_id")


@query("recordable_action", """
    SELECT event_id FROM traj JOIN ability USING (ability) WHERE kind IN ('Build', 'BuildOnUnit', 'BuildInstant', 'Train',
        'Research') OR traj.ability = 'UPGRADETOORBITAL_ORBITALCOMMAND'""", using="traj ability")
def recordable_action(spark, sf):
    rows = traj_raw(spark, sf).join(graph(spark, "ability"), "ability")
    return rows.filter(P.recordable(F.col("kind"), F.col("ability"))).select("event_id")


@query("recordable_part", "SELECT p_partkey FROM part WHERE p_type <> 'PROMO' OR p_brand IN ('Brand#1', 'Brand#2')")
def recordable_part(spark, sf):
    rows = table(spark, sf, "part")
    kind = F.when(F.col("p_type") == "PROMO", "Morph").otherwise("Train")
    action = F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), P.RECORDED_MORPHS[0]).otherwise(F.col("p_name"))
    return rows.filter(P.recordable(kind, action)).select("p_partkey")


@query("semantic_target", """
    WITH s AS (SELECT event_id, CASE k % 4 WHEN 0 THEN ability WHEN 1 THEN 'BUILD_GENERIC' WHEN 2 THEN 'RESEARCH_OTHER'
                   ELSE 'NOTHING' END AS ability FROM traj)
    SELECT event_id, s.ability, CASE s.ability WHEN 'BUILD_GENERIC' THEN 'Build' WHEN 'RESEARCH_OTHER' THEN 'Research'
            ELSE CASE WHEN kind <> 'Unit' THEN kind END END AS kind,
        CASE s.ability WHEN 'BUILD_GENERIC' THEN 'Barracks' WHEN 'RESEARCH_OTHER' THEN 'OTHER' ELSE result END AS target
    FROM s LEFT JOIN ability a ON a.ability = s.ability""", using="traj ability")
def semantic_target(spark, sf):
    form = F.col("k") % 4
    name = (F.when(form == 0, F.col("ability")).when(form == 1, "BUILD_GENERIC").when(form == 2, "RESEARCH_OTHER")
            .otherwise("NOTHING"))
    rows = traj_raw(spark, sf).select("event_id", name.alias("ability"))
    found = P.semantic_target(rows, graph(spark, "ability"), {"BUILD_GENERIC": "TERRANBUILD_BARRACKS"})
    return found.select("event_id", "ability", "kind", "target")


@query("resolve_host_action", """
    SELECT event_id, CASE WHEN k % 3 = 0 AND k % 5 < 3 THEN 'BUILD_TECHLAB_' || (['BARRACKS', 'FACTORY', 'STARPORT'])[k % 5 + 1]
        WHEN k % 3 = 0 THEN 'BUILD_TECHLAB' ELSE ability END AS ability FROM traj""", using="traj")
def resolve_host_action(spark, sf):
    hosts = text_array(["BARRACKS", "FACTORYFLYING", "STARPORT", "BUNKER", "ARMORY"])
    action = F.when(F.col("k") % 3 == 0, "BUILD_TECHLAB").otherwise(F.col("ability"))
    host = F.element_at(hosts, (F.col("k") % 5 + 1).cast("int"))
    return traj_raw(spark, sf).select("event_id", P.host_action(action, host).alias("ability"))


@query("step_text_pick", """
    SELECT doc_id, CASE WHEN lang = 'en' THEN source WHEN lang = 'fr' THEN lang WHEN n_chars > 400 THEN 'v6' ELSE '' END AS text
    FROM documents""")
def step_text_pick(spark, sf):
    v8 = F.when(F.col("lang") == "en", F.col("source")).otherwise("")
    v7 = F.when(F.col("lang") == "fr", F.col("lang"))
    v6 = F.when(F.col("n_chars") > 400, "v6")
    return table(spark, sf, "documents").select("doc_id", P.first_text(v8, v7, v6).alias("text"))


@query("drop_llm_fields", "SELECT conv_id, turns, user_text FROM sample", using="sample")
def drop_llm_fields(spark, sf):
    rows = sample(spark, sf).withColumnRenamed("system", "prompt").withColumnRenamed("user", "user_text")
    return rows.drop(*P.DROPPED_FIELDS)


@query("slim_projection", """
    SELECT conv_id, coalesce(system, '') AS system, coalesce(user_text, '') AS user_text, CAST(turns AS VARCHAR) AS golden_tags
    FROM sample""", using="sample")
def slim_projection(spark, sf):
    return sample(spark, sf).select(
        "conv_id", X.or_empty(F.col("system")).alias("system"), X.or_empty(F.col("user")).alias("user_text"),
        F.concat_ws(",", F.array(F.col("turns").cast("string"))).alias("golden_tags"))


@query("task_range_filter", """
    SELECT l_orderkey AS index, count(*) AS total FROM lineitem GROUP BY 1 HAVING count(*) BETWEEN 3 AND 6""")
def task_range_filter(spark, sf):
    rows = order_items(spark, sf).withColumn("total", L.item_total(F.col("items")))
    return rows.filter(P.in_range(F.col("total"), 3, 6)).select("index", "total")


@query("task_range_skipped", """
    SELECT CASE WHEN n < 3 OR n > 6 THEN 'task_out_of_range' ELSE 'kept' END AS status, count(*) AS records
    FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1""")
def task_range_skipped(spark, sf):
    rows = order_items(spark, sf).withColumn("total", L.item_total(F.col("items")))
    status = F.when(P.in_range(F.col("total"), 3, 6), "kept").otherwise("task_out_of_range")
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("records"))


@query("laststep_items", f"""
    WITH {CLASSED_ITEMS} SELECT index, sum(n) FILTER (index % 4 < 2) AS total, bool_or(index % 4 > 2) AS rejected
    FROM pairs GROUP BY index""")
def laststep_items(spark, sf):
    form = F.col("index") % 4
    rows = order_items(spark, sf).select(
        "index", F.when(form == 0, F.col("items")).alias("named"),
        F.when(form == 1, X.items_json(F.col("items"))).when(form == 2, '{"items": [{"name": "x"}]}').otherwise("oops").alias("answer"))
    parsed = F.from_json("answer", "struct<items:array<struct<name:string,count:int>>>")["items"]
    items = F.coalesce(F.when(F.size("named") > 0, F.transform("named", lambda i: F.struct(
        i["name"].alias("name"), i["count"].cast("int").alias("count")))), F.when(F.size(parsed) > 0, parsed))
    return rows.select("index", L.item_total(items).alias("total"), items.isNull().alias("rejected"))


STEM = "regexp_replace(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}_-]', '_', 'g'), '\\A_+|_+\\z', '', 'g')"


@query("sample_key", f"""
    SELECT page_id, {STEM.format("'bot_' || CASE WHEN page_id % 3 = 0 THEN 'unknown' ELSE url END || '_' || CASE WHEN page_id % 2 = 0 "
                                 "THEN 'unknown_map' ELSE 'Map 1' END || '_' || 'file' || page_id")}
        || '/step_' || lpad(CAST(page_id % 7 AS VARCHAR), 3, '0') AS key FROM pages""")
def sample_key(spark, sf):
    page = F.col("page_id")
    opponent = F.when(page % 3 != 0, F.col("url"))
    map_name = F.when(page % 2 == 0, "").otherwise("Map 1")
    stem = F.concat(F.lit("file"), page.cast("string"))
    key = X.sample_key(F.lit("bot"), opponent, map_name, F.lit(None).cast("string"), stem)
    step = F.concat(F.lit("/step_"), F.lpad((page % 7).cast("string"), 3, "0"))
    return table(spark, sf, "pages").select("page_id", F.concat(key, step).alias("key"))


@query("legacy_key_fallback", """
    SELECT o_orderkey, CASE WHEN n.c_custkey IS NOT NULL THEN 'new' WHEN l.c_custkey IS NOT NULL THEN 'legacy'
        ELSE 'skipped_missing' END AS source FROM orders
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) n ON n.c_custkey = o_custkey
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') l ON l.c_custkey = o_custkey""")
def legacy_key_fallback(spark, sf):
    customer = table(spark, sf, "customer").withColumn("key", F.col("c_custkey"))
    new = customer.filter(F.col("c_acctbal") > 5000).select("key", F.lit("new").alias("_new"))
    old = customer.filter(F.col("c_mktsegment") == "BUILDING").select("key", F.lit("legacy").alias("_old"))
    rows = table(spark, sf, "orders").withColumn("key", F.col("o_custkey"))
    return rows.join(new, "key", "left").join(old, "key", "left").select(
        "o_orderkey", F.coalesce("_new", "_old", F.lit("skipped_missing")).alias("source"))


@query("bot_folder", """
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'bot' || page_id WHEN 1 THEN 'top' ELSE NULL END AS bot FROM pages""")
def bot_folder(spark, sf):
    page = F.col("page_id").cast("string")
    form = F.col("page_id") % 3
    path = (F.when(form == 0, F.concat(F.lit("run/bot"), page, F.lit("/sequences/a.json")))
            .when(form == 1, F.lit("top/x/y/a.json")).otherwise("a.json"))
    return table(spark, sf, "pages").select("page_id", X.bot_folder(path).alias("bot"))


@query("difficulty_of", """
    SELECT doc_id, CASE WHEN lang = 'en' THEN 'stated' WHEN lang = 'fr' THEN 'veryhard' WHEN lang = 'de' THEN 'medium'
        ELSE 'unknown' END AS difficulty, CASE WHEN lang = 'en' THEN 'zerg' WHEN lang = 'fr' THEN 'protoss' ELSE 'unknown' END
        AS race FROM documents""")
def difficulty_of(spark, sf):
    lang = F.col("lang")
    stated, race = F.when(lang == "en", " Stated "), F.when(lang == "en", "Zerg").otherwise("any")
    opponent = F.when(lang == "fr", "ai.protoss.Easy.VeryHard.rush").when(lang == "de", "ai.none").otherwise("")
    stem = F.when(lang == "de", "game hard_Medium_1").otherwise("game_7")
    return table(spark, sf, "documents").select(
        "doc_id", X.difficulty_of(stated, opponent, stem).alias("difficulty"), X.race_of(race, opponent).alias("race"))


@query("race_of", """
    SELECT match_id, CASE WHEN race = 'Zerg' THEN 'zerg' WHEN race = 'Terran' THEN 'protoss' ELSE 'unknown' END AS race FROM match""",
       using="match")
def race_of(spark, sf):
    stated = F.when(F.col("race") == "Zerg", F.col("race")).otherwise("random")
    opponent = F.when(F.col("race") == "Terran", "bot.Protoss.hard").otherwise("bot")
    return match(spark, sf).select("match_id", X.race_of(stated, opponent).alias("race"))


@query("unit_type_filter", """
    SELECT tag, type FROM pos WHERE type IN ('SMALL', 'LARGE', 'PROMO') AND type <> 'PROMO'
        AND tag IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)
        AND tag NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 1)""", using="pos")
def unit_type_filter(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("tag"), "l_quantity")
    kept = pos(spark, sf).filter(F.col("type").isin("SMALL", "LARGE", "PROMO") & ~F.col("type").isin("PROMO"))
    return kept.join(lines.filter("l_quantity = 50"), "tag", "left_semi").join(
        lines.filter("l_quantity = 1"), "tag", "left_anti").select("tag", "type")


@query("type_lookup", "SELECT tag, type FROM pos WHERE type IN ('SMALL', 'MEDIUM') AND tag IN (SELECT l_suppkey FROM lineitem)",
       using="pos")
def type_lookup(spark, sf):
    asked = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("tag"))
    return S.by_tag(pos(spark, sf).filter(F.col("type").isin("SMALL", "MEDIUM")), asked, "tag").select("tag", "type")


@query("unit_state_filters", """
    WITH u AS (SELECT *, l_tax = 0 AS ready FROM lineitem)
    SELECT 'ready owned' AS filter, count(*) AS n FROM u WHERE ready AND l_linestatus = 'O'
    UNION ALL SELECT 'not_ready enemy flying', count(*) FROM u WHERE NOT ready AND l_linestatus = 'F' AND l_returnflag = 'A'
    UNION ALL SELECT 'idle not_flying structure', count(*) FROM u WHERE l_discount = 0 AND l_returnflag <> 'A' AND l_linenumber > 3
    UNION ALL SELECT 'not_structure collecting', count(*) FROM u WHERE l_linenumber <= 3 AND l_quantity < 20
    UNION ALL SELECT 'gathering', count(*) FROM u WHERE l_quantity < 10
    UNION ALL SELECT 'returning', count(*) FROM u WHERE l_quantity >= 10 AND l_quantity < 20
    UNION ALL SELECT 'visible mineral_field', count(*) FROM u WHERE l_returnflag <> 'N' AND l_linenumber = 1
    UNION ALL SELECT 'vespene_geyser selected', count(*) FROM u WHERE l_linenumber = 2 AND l_quantity > 45""")
def unit_state_filters(spark, sf):
    q, flag, line = F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        F.when(F.col("l_tax") == 0, 1.0).otherwise(0.5).alias("progress"), F.col("l_discount").alias("orders"),
        (F.col("l_linestatus") == "O").alias("mine"), (flag == "A").alias("flying"), (line > 3).alias("structure"),
        F.when(q < 10, "gathering").when(q < 20, "returning").alias("activity"),
        F.when(flag == "N", "snapshot").otherwise("visible").alias("display"),
        F.when(line == 1, "mineral").when(line == 2, "vespene").alias("resource"), (q > 45).alias("selected"))
    named = ["ready owned", "not_ready enemy flying", "idle not_flying structure", "not_structure collecting",
             "gathering", "returning", "visible mineral_field", "vespene_geyser selected"]
    # One pass counts every combination of states.
    def holds(name):
        condition = F.lit(True)
        for state in name.split():
            condition = condition & P.UNIT_STATES[state]()
        return condition

    counts = rows.agg(*[F.count_if(F.coalesce(holds(n), F.lit(False))).alias(n) for n in named])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("filter"), F.col(f"`{n}`").alias("n")) for n in named])))


ALIASES = [("SMALL", "MEDIUM"), ("LARGE", "PROMO")]


@query("same_tech", "SELECT tag, type FROM pos WHERE type IN ('MEDIUM', 'SMALL', 'LARGE')", using="pos")
def same_tech(spark, sf):
    # LARGE is wanted; MEDIUM brings SMALL in, whose own alias it is.
    aliases = values_frame(spark, ["type", "alias"], [("SMALL", "MEDIUM"), ("LARGE", "SMALL")])
    found = P.of_alias(pos(spark, sf), ["MEDIUM", "LARGE"], aliases, both=True)
    return found.select("tag", "type")


@query("same_unit", "SELECT tag, type FROM pos WHERE type IN ('SMALL', 'MEDIUM', 'PROMO')", using="pos")
def same_unit(spark, sf):
    aliases = values_frame(spark, ["type", "alias"], ALIASES)
    return P.of_alias(pos(spark, sf), ["SMALL", "PROMO"], aliases, both=False).select("tag", "type")


@query("real_type", """
    SELECT type, count(*) AS n FROM (SELECT CASE type WHEN 'PROMO' THEN 'LARGE' WHEN 'MEDIUM' THEN 'SMALL' ELSE type END AS type
        FROM units) GROUP BY type""", using="units")
def real_type(spark, sf):
    base = values_frame(spark, ["type", "real"], [("PROMO", "LARGE"), ("MEDIUM", "SMALL")])
    rows = units(spark, sf).join(base, "type", "left").select(F.coalesce("real", "type").alias("type"))
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query("take", "SELECT tag, type FROM pos ORDER BY tag LIMIT 15", using="pos")
def take(spark, sf):
    return K.take(pos(spark, sf).select("tag", "type"), 15, [F.col("tag")])


@query("random_group", "SELECT tag FROM pos ORDER BY sha256('7:' || tag), tag LIMIT 12", using="pos")
def random_group(spark, sf):
    return K.random_group(pos(spark, sf), 12, "tag", 7).select("tag")


@query("prefer_idle", """
    SELECT prompt, tag, line FROM cand ORDER BY is_idle DESC, prompt, line, tag, part LIMIT 20""", using="cand")
def prefer_idle(spark, sf):
    order = [F.col(c) for c in ("prompt", "line", "tag", "part")]
    return K.take(cand(spark, sf), 20, order, first=F.col("is_idle")).select("prompt", "tag", "line")
