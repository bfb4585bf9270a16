
"""Counts, sums and keys per step, class, side and match."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.operators import counts
from stepforge.operators import listing as L
from stepforge.operators.actions import action_to_item
from stepforge.plans import reports, resample
from stepforge.plans import steps as step_plans
from stepforge.workload.graph_rows import graph, values_frame
from stepforge.workload.registry import query
from stepforge.workload.views import audit, hour_of, match, step, table, traj_raw

KEYS = ["traj_id", "step_id"]
ITEM_KINDS = "('Build', 'BuildOnUnit', 'BuildInstant', 'Train', 'Morph', 'Research')"
ITEMS_SQL = f"""items AS (
    SELECT traj_id, step_id, result AS name, count(*) AS n FROM step JOIN ability USING (ability)
    WHERE kind IN {ITEM_KINDS} GROUP BY ALL)"""


def step_items(spark, sf):
    return L.named_items(action_to_item(step(spark, sf), graph(spark, "ability")), KEYS, "item")


@query("named_items", f"""
    WITH {ITEMS_SQL} SELECT traj_id, step_id, string_agg(name || ':' || n, ',' ORDER BY name) AS items
    FROM items GROUP BY traj_id, step_id""", using="step ability")
def named_items(spark, sf):
    text = F.concat_ws(",", F.transform("items", lambda i: F.concat(i["name"], F.lit(":"), i["count"].cast("string"))))
    return step_items(spark, sf).select(*KEYS, text.alias("items"))


ENTRIES_SQL = """entries AS (
    SELECT traj_id, step_id, ability, min(seq) AS f, count(*) AS n FROM step GROUP BY ALL)"""


@query("counted_list", f"""
    WITH {ENTRIES_SQL} SELECT traj_id, step_id, string_agg(
        CASE WHEN n > 1 THEN ability || ' x ' || n ELSE ability END, chr(10) ORDER BY f) AS lines
    FROM entries GROUP BY traj_id, step_id""", using="step")
def counted_list(spark, sf):
    rows = L.first_seen_counts(step(spark, sf), KEYS, "ability", "seq")
    return rows.select(*KEYS, L.counted_text(F.col("entries")).alias("lines"))


@query("pending_summary", f"""
    WITH {ENTRIES_SQL} SELECT traj_id, step_id, string_agg(CASE WHEN n > 1
        THEN '  - ' || ability || ' x' || n || ' (0/' || n || ' issued) [PENDING]'
        ELSE '  - ' || ability || ' [PENDING]' END, chr(10) ORDER BY f) AS lines
    FROM entries GROUP BY traj_id, step_id""", using="step")
def pending_summary(spark, sf):
    rows = L.first_seen_counts(step(spark, sf), KEYS, "ability", "seq")
    return rows.select(*KEYS, L.pending_text(F.col("entries")).alias("lines"))


CATEGORY_SQL = """CASE WHEN ability LIKE 'UPGRADETO%' THEN 'Morph' WHEN is_structure THEN 'Build' WHEN is_addon
    THEN 'Addon' WHEN type = 'Unit' THEN 'Train' WHEN type = 'Upgrade' THEN 'Research' ELSE 'Other' END"""


@query("category_counts", f"""
    WITH c AS (SELECT traj_id, step_id, {CATEGORY_SQL} AS cat, result AS product, min(seq) AS f, count(*) AS n
        FROM step JOIN ability USING (ability) LEFT JOIN entity ON result = name
        WHERE result IS NOT NULL GROUP BY ALL)
    SELECT traj_id, step_id, string_agg('  [' || cat || '] ' || product || ': x' || n, chr(10) ORDER BY
        list_position(['Build', 'Train', 'Addon', 'Research', 'Morph', 'Other'], cat), f) AS lines
    FROM c GROUP BY traj_id, step_id""", using="step ability entity")
def category_counts(spark, sf):
    rows = step(spark, sf).join(graph(spark, "ability"), "ability").filter(F.col("result").isNotNull())
    rows = rows.join(graph(spark, "entity"), F.col("result") == F.col("name"), "left")
    return step_plans.category_lines(rows, KEYS, "result")


CLASSED_ITEMS = """pairs AS (
    SELECT l_orderkey AS index, p_type AS name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY ALL)"""


def order_items(spark, sf):
    """Items per order: part types with their counts."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("index"), F.col("l_partkey").alias("p_partkey"))
    return L.named_items(lines.join(table(spark, sf, "part").select("p_partkey", "p_type"), "p_partkey"),
                         ["index"], "p_type")


@query("class_key", f"""
    WITH {CLASSED_ITEMS} SELECT index, string_agg(name, '|' ORDER BY name) AS class FROM pairs GROUP BY index""")
def class_key(spark, sf):
    return order_items(spark, sf).select("index", F.concat_ws("|", L.class_key(F.col("items"))).alias("class"))


@query("multiset_key", f"""
    WITH {CLASSED_ITEMS}, labels AS (SELECT index, string_agg(CASE WHEN n > 1 THEN name || 'x' || n ELSE name END,
        ', ' ORDER BY name) AS label FROM pairs GROUP BY index)
    SELECT label, count(*) AS n FROM labels GROUP BY label""")
def multiset_key(spark, sf):
    labels = order_items(spark, sf).select(L.multiset_label(F.col("items")).alias("label"))
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("multiset_equal", f"""
    WITH {CLASSED_ITEMS}, keyed AS (SELECT index, list((name, n) ORDER BY name) AS items FROM pairs GROUP BY index)
    SELECT a.index, b.index IS NOT NULL AND a.items = b.items AS equal FROM keyed a
    LEFT JOIN keyed b ON b.index = a.index + 1""")
def multiset_equal(spark, sf):
    items = order_items(spark, sf)
    following = items.select((F.col("index") - 1).alias("index"), F.col("items").alias("other"))
    equal = F.coalesce(L.multiset_equal(F.col("items"), F.col("other")), F.lit(False))
    return items.join(following, "index", "left").select("index", equal.alias("equal"))


@query("task_count_dist", """
    SELECT n AS task_count, count(*) AS records FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
    GROUP BY 1""")
def task_count_dist(spark, sf):
    totals = order_items(spark, sf).select(L.item_total(F.col("items")).alias("task_count"))
    return totals.groupBy("task_count").agg(F.count(F.lit(1)).alias("records"))


@query("step_balance", """
    SELECT CAST(min(n) AS DOUBLE) AS min, CAST(max(n) AS DOUBLE) AS max, round(max(n) / min(n), 6) AS ratio,
           round(stddev_pop(n), 6) AS std
    FROM (SELECT step_id, count(*) AS n FROM (SELECT DISTINCT traj_id, step_id FROM step) GROUP BY step_id)""",
       using="step")
def step_balance(spark, sf):
    return resample.step_balance(step(spark, sf).select(*KEYS).distinct(), "step_id")


@query("macro_shape", """
    SELECT traj_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
           count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
           count(*) FILTER (event_type = 'view') AS view
    FROM traj GROUP BY traj_id""", using="traj")
def macro_shape(spark, sf):
    return counts.family_counts(traj_raw(spark, sf), ["traj_id"], "event_type",
                                ["click", "error", "purchase", "signup", "view"])


@query("cumulative_build", """
    SELECT event_id, traj_id, result AS product, row_number() OVER (PARTITION BY traj_id, result ORDER BY us, event_id)
           AS so_far, 12 + count(*) FILTER (result = 'SCV') OVER (PARTITION BY traj_id ORDER BY us, event_id) AS workers
    FROM traj JOIN ability USING (ability) WHERE result IS NOT NULL""", using="traj ability")
def cumulative_build(spark, sf):
    rows = traj_raw(spark, sf).join(graph(spark, "ability"), "ability").filter(F.col("result").isNotNull())
    return step_plans.cumulative_build(rows.withColumnRenamed("result", "product"), "traj_id", ["us", "event_id"],
                                       hour_of()).select("event_id", "traj_id", "product", "so_far", "workers")


@query("build_summary_text", """
    WITH c AS (SELECT traj_id, result, is_structure OR is_addon AS building, type, count(*) AS n, min(us) AS f
               FROM traj JOIN ability USING (ability) JOIN entity ON result = name GROUP BY ALL)
    SELECT traj_id, concat_ws(chr(10),
        'Structures: ' || string_agg(CASE WHEN n = 1 THEN '1st ' || result ELSE n || 'x ' || result END, ', ' ORDER BY result)
            FILTER (type = 'Unit' AND building),
        'Units: ' || string_agg(n || 'x ' || result, ', ' ORDER BY result) FILTER (type = 'Unit' AND NOT building),
        'SCV count: ' || CAST(12 + coalesce(sum(n) FILTER (result = 'SCV'), 0) AS BIGINT),
        'Upgrades done: ' || string_agg(result, ', ' ORDER BY f, result) FILTER (type = 'Upgrade')) AS summary
    FROM c GROUP BY traj_id""", using="traj ability entity")
def build_summary_text(spark, sf):
    rows = traj_raw(spark, sf).join(graph(spark, "ability"), "ability")
    rows = rows.join(graph(spark, "entity"), F.col("result") == F.col("name"))
    return step_plans.build_summary(rows, "traj_id", "us")


@query("relation_distribution", """
    SELECT p_type AS relation, l_returnflag AS subject_table, count(*) AS edges, grouping(p_type) AS all_relations,
           grouping(l_returnflag) AS all_tables
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY GROUPING SETS ((p_type), (l_returnflag), ())""")
def relation_distribution(spark, sf):
    edges = table(spark, sf, "lineitem").select("l_partkey", F.col("l_returnflag").alias("subject_table"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("relation"))
    return counts.relation_distribution(edges.join(parts, "l_partkey"))


@query("canonical_list", """
    SELECT p_brand AS race, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS units FROM part GROUP BY p_brand""")
def canonical_list(spark, sf):
    names = table(spark, sf, "part").groupBy(F.col("p_brand").alias("race")).agg(
        F.array_sort(F.collect_set("p_name")).alias("units"))
    return names.select("race", F.concat_ws(",", "units").alias("units"))


@query("units_created", """
    SELECT result AS type, count(*) AS created FROM traj JOIN ability USING (ability)
    WHERE kind = 'Train' GROUP BY result""", using="traj ability")
def units_created(spark, sf):
    trained = traj_raw(spark, sf).join(graph(spark, "ability").filter(F.col("kind") == "Train"), "ability")
    return trained.groupBy(F.col("result").alias("type")).agg(F.count(F.lit(1)).alias("created"))


@query("race_from_orders", """
    SELECT l_orderkey AS game, coalesce(arg_min(CASE p_type WHEN 'SMALL' THEN 'Terran' WHEN 'LARGE' THEN 'Zerg'
        ELSE 'Protoss' END, (l_linenumber, l_partkey)) FILTER (p_type IN ('SMALL', 'LARGE', 'PROMO')), 'Random') AS race
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def race_from_orders(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    worker = {"SMALL": "Terran", "LARGE": "Zerg", "PROMO": "Protoss"}
    return counts.race_from_orders(lines.join(parts, "l_partkey"), F.col("l_orderkey").alias("game"),
                                   F.col("p_type"), F.struct("l_linenumber", "l_partkey"), worker)


@query("resource_stats", """
    SELECT traj_id, max(value) AS max_value, round(avg(value), 6) AS mean_value FROM traj GROUP BY traj_id""",
       using="traj")
def resource_stats(spark, sf):
    return traj_raw(spark, sf).groupBy("traj_id").agg(
        F.max("value").alias("max_value"), F.round(F.avg("value"), 6).alias("mean_value"))


@query("win_summary", """
    SELECT bot, count(*) AS games, count(*) FILTER (victory) AS wins, count(*) - count(*) FILTER (victory) AS losses
    FROM match GROUP BY ROLLUP (bot)""", using="match")
def win_summary(spark, sf):
    return counts.win_summary(match(spark, sf), "bot", F.col("victory"))


@query("task_grid", """
    SELECT bot, race, difficulty, row_number() OVER (ORDER BY bot, race, difficulty) - 1 AS task
    FROM (SELECT DISTINCT c_mktsegment AS bot FROM customer),
         (SELECT unnest(['Protoss', 'Terran', 'Zerg']) AS race),
         (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM']) AS difficulty)""")
def task_grid(spark, sf):
    bots = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("bot")).distinct()
    return counts.task_grid(bots, ["Protoss", "Terran", "Zerg"], ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("group_by_bot", """
    SELECT bot, position, count(*) AS tasks FROM match JOIN (
        SELECT * FROM (VALUES ('MACHINERY', 0), ('BUILDING', 1), ('AUTOMOBILE', 2), ('HOUSEHOLD', 3)) t(bot, position))
    USING (bot) GROUP BY ALL""", using="match")
def group_by_bot(spark, sf):
    order = values_frame(spark, ["bot", "position"], [
        ("MACHINERY", 0), ("BUILDING", 1), ("AUTOMOBILE", 2), ("HOUSEHOLD", 3)])
    return match(spark, sf).join(order, "bot").groupBy("bot", "position").agg(
        F.count(F.lit(1)).alias("tasks")).orderBy("position")


@query("obs_qa", """
    SELECT CAST(count(DISTINCT traj_id) AS BIGINT) AS files, count(*) AS actions,
           count(*) FILTER (event_type = 'error') AS missing_text, count(*) FILTER (value < 5) AS missing_structured,
           CAST(count(DISTINCT traj_id) FILTER (k = 99) AS BIGINT) AS order_mismatch,
           count(*) FILTER (ability LIKE '%TRAIN%' AND k % 4 > 1) AS train_multi FROM traj""", using="traj")
def obs_qa(spark, sf):
    rows = traj_raw(spark, sf).withColumn("listed", F.when(F.col("k") == 99, "OTHER").otherwise(F.col("ability")))
    return reports.obs_qa(rows, "traj_id", text_missing=F.col("event_type") == "error",
                          structured_missing=F.col("value") < 5, mismatch=F.col("ability") != F.col("listed"),
                          multi=F.col("ability").contains("TRAIN") & (F.col("k") % 4 > 1))


@query("label_qa", """
    WITH expected AS (SELECT doc_id AS key FROM labels WHERE quality = 1), docs AS (
        SELECT doc_id AS key, contains(text, 'the ') AS valid FROM documents WHERE lang <> 'de'),
    t AS (SELECT count(e.key) AS expected, count(*) FILTER (e.key IS NOT NULL AND d.key IS NOT NULL) AS existing,
        count(*) FILTER (e.key IS NOT NULL AND valid) AS valid, count(*) FILTER (e.key IS NOT NULL AND NOT valid) AS invalid,
        count(*) FILTER (e.key IS NOT NULL AND d.key IS NULL) AS missing FROM expected e FULL JOIN docs d ON e.key = d.key)
    SELECT *, invalid = 0 AND missing = 0 AND expected = valid AND existing > 0 AS passed FROM t""")
def label_qa(spark, sf):
    expected = table(spark, sf, "labels").filter(F.col("quality") == 1).select(F.col("doc_id").alias("key"))
    docs = table(spark, sf, "documents").filter(F.col("lang") != "de").select(
        F.col("doc_id").alias("key"), F.col("text").contains("the ").alias("valid"))
    return reports.label_qa(expected, docs, "key")


@query("label_row_issues", """
    SELECT doc_id, concat_ws(',', CASE WHEN trim(text) = '' THEN 'empty_step_text' END,
        CASE WHEN contains(text, '[') THEN 'llm_call_failed_mark' END,
        CASE WHEN lang = 'de' THEN 'missing_obs_text' END) AS issues
    FROM documents WHERE trim(text) = '' OR contains(text, '[') OR lang = 'de' ORDER BY doc_id LIMIT 50""")
def label_row_issues(spark, sf):
    return reports.row_issues(table(spark, sf, "documents"), "doc_id", F.col("text"), F.lit("["),
                              F.col("lang") == "de", 50)


@query("recovery_qa", """
    SELECT CASE WHEN quality IS NULL THEN 'skipped_missing' WHEN text IS NULL THEN 'skipped_no_document'
                WHEN quality = 0 THEN 'skipped_invalid' ELSE 'matched' END AS status, count(*) AS n
    FROM documents FULL JOIN labels USING (doc_id) GROUP BY 1""")
def recovery_qa(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id", "full")
    status = (F.when(F.col("quality").isNull(), "skipped_missing").when(F.col("text").isNull(), "skipped_no_document")
              .when(F.col("quality") == 0, "skipped_invalid").otherwise("matched"))
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("fail_reasons", """
    WITH r AS (SELECT unnest([CASE WHEN n_chars < 500 THEN 'too short' END,
        CASE WHEN quality = 0 THEN 'low quality' END, CASE WHEN toxic = 1 THEN 'toxic' END,
        'source ' || source]) AS reason FROM labels JOIN documents USING (doc_id))
    SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason LIMIT 10""")
def fail_reasons(spark, sf):
    rows = audit(spark, sf).withColumn("reasons", F.array_compact(F.array(
        F.when(F.col("n_chars") < 500, "too short"), F.when(~F.col("passed"), "low quality"),
        F.when(F.col("dropped"), "toxic"), F.concat(F.lit("source "), "source"))))
    return reports.fail_reasons(rows, "reasons", 10)


@query("injection_progress", """
    SELECT lang AS task, count(*) FILTER (n_chars > 0) AS generated, count(*) FILTER (passed) AS rule_pass,
           count(*) FILTER (passed AND NOT dropped) AS kept, count(*) FILTER (NOT passed) AS drop_rule_check,
           count(*) FILTER (passed AND dropped) AS drop_teacher
    FROM audit GROUP BY lang""", using="audit")
def injection_progress(spark, sf):
    rows = audit(spark, sf).select(
        F.col("lang").alias("task"), (F.col("n_chars") > 0).alias("generated"), F.col("passed").alias("rule_passed"),
        F.when(~F.col("passed"), "rule_check").when(F.col("dropped"), "teacher_drop").alias("stage"))
    return reports.injection_progress(rows, "task")
