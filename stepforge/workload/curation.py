"""Classes of answers, their coverage, curation and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.operators import listing as L
from stepforge.operators import picking as K
from stepforge.operators.keyed import first_per_key
from stepforge.operators.ordered import numbered
from stepforge.plans import curate as C
from stepforge.plans import resample as R
from stepforge.session import cut_lineage
from stepforge.workload.aggregations import order_items
from stepforge.workload.registry import query
from stepforge.workload.views import audit, match, table, text_array

CLASSED = """classed AS (SELECT o.o_orderkey AS index, class, label, total, 'prompt ' || o_custkey AS prompt, o_orderstatus AS status,
    o_orderpriority AS priority, o_totalprice AS price, o_custkey % 20 + 1 AS step, o_orderpriority || ' ' || o_custkey % 50 AS summary
    FROM orders o JOIN (SELECT l_orderkey, string_agg(p_type, '|' ORDER BY p_type) AS class,
        string_agg(CASE WHEN n > 1 THEN p_type || 'x' || n ELSE p_type END, ', ' ORDER BY p_type) AS label, sum(n) AS total
        FROM (SELECT l_orderkey, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
        GROUP BY l_orderkey) c ON c.l_orderkey = o.o_orderkey)"""


def classed(spark, sf):
    """Orders as samples: the class and multiset of their part types, the customer as prompt."""
    items = order_items(spark, sf).select(
        F.col("index").alias("o_orderkey"), F.concat_ws("|", L.class_key(F.col("items"))).alias("class"),
        L.multiset_label(F.col("items")).alias("label"), L.item_total(F.col("items")).alias("total"))
    rows = table(spark, sf, "orders").join(items, "o_orderkey")
    customer = F.col("o_custkey")
    return rows.select(
        F.col("o_orderkey").alias("index"), "class", "label", "total", F.concat(F.lit("prompt "), customer.cast("string")).alias("prompt"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"),
        (customer % 20 + 1).alias("step"), F.concat_ws(" ", "o_orderpriority", (customer % 50).cast("string")).alias("summary"))


def covered(rows):
    sft = rows.filter("status = 'F' AND price > 300000").select("class", "prompt")
    audits = rows.filter("status = 'O' AND priority = '1-URGENT'").select("class", "prompt")
    drops = rows.filter("status = 'O' AND priority = '2-HIGH' AND price > 100000").select("class", "prompt")
    return C.class_coverage([sft, audits, drops])


COVER = CLASSED + """, cover AS (SELECT class, count(DISTINCT prompt) AS cot FROM classed WHERE (status = 'F' AND price > 300000)
    OR (status = 'O' AND (priority = '1-URGENT' OR (priority = '2-HIGH' AND price > 100000))) GROUP BY class)"""
STATS = COVER + """, last AS (SELECT prompt, arg_max(class, index) AS class FROM classed WHERE status = 'P' GROUP BY prompt),
    stats AS (SELECT class, pending, coalesce(cot, 0) AS cot, CASE WHEN coalesce(cot, 0) = 0 THEN 'none' WHEN cot <= 40 THEN 'sparse'
        ELSE 'ok' END AS coverage FROM (SELECT class, count(*) AS pending FROM last GROUP BY class) LEFT JOIN cover USING (class))"""


@query("class_coverage", f"WITH {COVER} SELECT class, cot FROM cover")
def class_coverage(spark, sf):
    return covered(classed(spark, sf))


def stats(spark, sf):
    rows = classed(spark, sf)
    return C.coverage_stats(rows.filter("status = 'P'"), covered(rows), 40)


@query("coverage_stats", f"WITH {STATS} SELECT class, pending, cot, coverage FROM stats")
def coverage_stats(spark, sf):
    return stats(spark, sf)


@query("coverage_histogram", f"WITH {STATS} SELECT cot, count(*) AS classes FROM stats WHERE cot > 0 GROUP BY cot")
def coverage_histogram(spark, sf):
    return stats(spark, sf).filter(F.col("cot") > 0).groupBy("cot").agg(F.count(F.lit(1)).alias("classes"))


@query("class_sort", f"WITH {STATS} SELECT class, pending FROM stats ORDER BY pending DESC, class")
def class_sort(spark, sf):
    return stats(spark, sf).select("class", "pending").orderBy(F.desc("pending"), "class")


BELOW = COVER + """, pend AS (SELECT * FROM classed WHERE status = 'P'), short AS (SELECT class, coalesce(cot, 0) AS cot,
        least(pending, 60) AS target FROM (SELECT class, count(*) AS pending FROM pend GROUP BY class) LEFT JOIN cover USING (class)
        WHERE coalesce(cot, 0) < least(pending, 60)),
    below AS (SELECT index, class, cot, target, row_number() OVER (ORDER BY index) - 1 AS subset_index FROM pend JOIN short USING (class))"""


@query("below_target", f"WITH {BELOW} SELECT index, class, cot, target FROM below")
def below_target(spark, sf):
    rows = classed(spark, sf)
    return C.below_target(rows.filter("status = 'P'"), covered(rows), 60).select("index", "class", "cot", "target")


@query("subset_index", f"WITH {BELOW} SELECT index, subset_index FROM below")
def subset_index(spark, sf):
    rows = classed(spark, sf)
    short = C.below_target(rows.filter("status = 'P'"), covered(rows), 60).select("index")
    return C.subset_index(short, "index", 1 << 20)


SOURCED = """sourced AS (SELECT doc_id AS load_order, left(text, 60) AS prompt, CASE doc_id % 3 WHEN 0 THEN '32b' WHEN 1 THEN '4b' ELSE '14b' END
        AS model, CASE WHEN lang = 'de' THEN 'laststep' ELSE source END AS source, lang || n_chars % 7 AS class FROM documents),
    deduped AS (SELECT * FROM sourced QUALIFY row_number() OVER (PARTITION BY prompt
        ORDER BY CASE model WHEN '4b' THEN 0 WHEN '14b' THEN 1 ELSE 2 END, load_order) = 1)"""


def sourced(spark, sf):
    docs = table(spark, sf, "documents")
    models = text_array(["32b", "4b", "14b"])
    return docs.select(
        F.col("doc_id").alias("load_order"), F.col("text").alias("prompt"),
        F.element_at(models, (F.col("doc_id") % 3 + 1).cast("int")).alias("model"),
        F.when(F.col("lang") == "de", "laststep").otherwise(F.col("source")).alias("source"),
        F.concat("lang", (F.col("n_chars") % 7).cast("string")).alias("class"))


SOURCED = SOURCED.replace("left(text, 60)", "text")


def deduped(spark, sf):
    return C.dedupe_prompt(sourced(spark, sf), C.model_order(F.col("model")), "load_order")


@query("dedupe_prompt", f"WITH {SOURCED} SELECT load_order, model, source FROM deduped")
def dedupe_prompt(spark, sf):
    return deduped(spark, sf).select("load_order", "model", "source")


CAPPED = SOURCED + """, capped AS (SELECT * FROM deduped QUALIFY row_number() OVER (PARTITION BY class
        ORDER BY CASE WHEN source = 'laststep' THEN 0 ELSE 1 END, prompt) <= 3)"""


@query("cap_per_class", f"WITH {CAPPED} SELECT load_order, class FROM capped")
def cap_per_class(spark, sf):
    return C.cap_per_class(deduped(spark, sf), 3).select("load_order", "class")


@query("cap_stats", f"""WITH {SOURCED} SELECT class, count(*) AS available, least(count(*), 3) AS selected, count(*) > 3 AS capped,
    count(*) < 3 AS under_target FROM deduped GROUP BY class""")
def cap_stats(spark, sf):
    return C.cap_stats(deduped(spark, sf), 3)


@query("curated_merge", f"""WITH {CAPPED}
    SELECT 'model ' || model AS measure, count(*) AS n FROM capped GROUP BY model
    UNION ALL SELECT 'source ' || source, count(*) FROM capped GROUP BY source
    UNION ALL SELECT 'loaded', count(*) FROM sourced UNION ALL SELECT 'after_dedupe', count(*) FROM deduped
    UNION ALL SELECT 'selected', count(*) FROM capped UNION ALL SELECT 'classes', count(DISTINCT class) FROM capped""")
def curated_merge(spark, sf):
    rows = sourced(spark, sf)
    few = C.cap_per_class(C.dedupe_prompt(rows, C.model_order(F.col("model")), "load_order"), 3)
    both = few.groupingSets([[F.col("model")], [F.col("source")], []], "model", "source").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("class").alias("c"), F.grouping_id().alias("g"))
    named = both.select(F.inline(F.when(F.col("g") == 1, F.array(F.struct(
        F.concat(F.lit("model "), "model").alias("measure"), F.col("n").alias("n")))).when(F.col("g") == 2, F.array(F.struct(
            F.concat(F.lit("source "), "source").alias("measure"), F.col("n").alias("n")))).otherwise(F.array(
                F.struct(F.lit("selected").alias("measure"), F.col("n").alias("n")),
                F.struct(F.lit("classes").alias("measure"), F.col("c").alias("n"))))))
    totals = rows.agg(F.count(F.lit(1)).alias("l"), F.countDistinct("prompt").alias("d")).select(F.inline(F.array(
        F.struct(F.lit("loaded").alias("measure"), F.col("l").alias("n")),
        F.struct(F.lit("after_dedupe").alias("measure"), F.col("d").alias("n")))))
    return named.unionByName(totals)


@query("curated_manifest", f"""WITH {CAPPED} SELECT load_order, class, source, model, substring(sha256(prompt), 1, 16) AS prompt_hash
    FROM capped""")
def curated_manifest(spark, sf):
    return C.cap_per_class(deduped(spark, sf), 3).select("load_order", "class", "source", "model",
                                                         X.prompt_hash(F.col("prompt")).alias("prompt_hash"))


@query("class_groups", f"""WITH {CAPPED} SELECT class, count(*) AS count, string_agg(load_order, ',' ORDER BY load_order) AS indices
    FROM capped GROUP BY class""")
def class_groups(spark, sf):
    # A class has at most three rows here, so its list is short.
    few = C.cap_per_class(deduped(spark, sf), 3).groupBy("class").agg(F.array_sort(F.collect_list("load_order")).alias("l"))
    return few.select("class", F.size("l").cast("bigint").alias("count"),
                      F.concat_ws(",", F.transform("l", lambda x: x.cast("string"))).alias("indices"))


UNION = """SELECT doc_id, 'cot_4b_full' AS source, '4b' AS model FROM documents WHERE lang = 'en' AND n_chars > 300
    UNION ALL SELECT doc_id, 'cot_14b_full', '14b' FROM documents WHERE lang = 'fr' AND n_chars > 300
    UNION ALL SELECT doc_id, 'cot_32b_full', '32b' FROM documents WHERE n_chars > 300
    UNION ALL SELECT doc_id, 'cot_32b_gap', '32b' FROM documents WHERE lang = 'de' AND n_chars > 300
    UNION ALL SELECT doc_id, 'cot_32b_priority', '32b' FROM labels JOIN documents USING (doc_id) WHERE quality = 1 AND n_chars > 300
    UNION ALL SELECT doc_id, 'cot_32b_priority_r2', '32b' FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 AND n_chars > 300
    UNION ALL SELECT doc_id, 'laststep_8_20', '32b' FROM documents WHERE lang = 'es' AND n_chars > 300"""


@query("multi_source_union", f"SELECT source, model, count(*) AS n FROM ({UNION}) GROUP BY ALL")
def multi_source_union(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("n_chars") > 300, F.col("text")).alias("cot"))
    labelled = docs.join(table(spark, sf, "labels"), "doc_id")
    few = ["doc_id", "cot"]
    rows = C.tagged_union([
        (docs.filter("lang = 'en'").select(few), "cot_4b_full", "4b"),
        (docs.filter("lang = 'fr'").select(few), "cot_14b_full", "14b"), (docs.select(few), "cot_32b_full", "32b"),
        (docs.filter("lang = 'de'").select(few), "cot_32b_gap", "32b"),
        (labelled.filter("quality = 1").select(few), "cot_32b_priority", "32b"),
        (labelled.filter("toxic = 1").select(few), "cot_32b_priority_r2", "32b"),
        (docs.filter("lang = 'es'").select(few), "laststep_8_20", "32b")])
    return rows.groupBy("source", "model").agg(F.count(F.lit(1)).alias("n"))


@query("prompt_answer_set", """
    WITH p AS (SELECT text AS user_text, 'pipeline' AS source, false AS is_last_step FROM documents WHERE lang <> 'de'),
    l AS (SELECT text AS user_text, 'laststep_qa' AS source, true AS is_last_step FROM documents WHERE lang = 'de' OR n_chars < 400)
    SELECT source, is_last_step, count(*) AS records, count(*) FILTER (is_last_step AND user_text IN (SELECT user_text FROM p)) AS overlap
    FROM (SELECT * FROM p UNION ALL SELECT * FROM l) GROUP BY ALL""")
def prompt_answer_set(spark, sf):
    docs = table(spark, sf, "documents")
    flat = lambda rows, source, last: rows.select(F.col("text").alias("user_text"), F.lit(source).alias("source"),
                                                  F.lit(last).alias("is_last_step"))
    pipeline = flat(docs.filter("lang <> 'de'"), "pipeline", False)
    last = flat(docs.filter("lang = 'de' OR n_chars < 400"), "laststep_qa", True)
    shared = pipeline.select("user_text").distinct().withColumn("_shared", F.lit(True))
    rows = pipeline.unionByName(last).join(shared, "user_text", "left")
    return rows.groupBy("source", "is_last_step").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("is_last_step") & F.col("_shared").isNotNull()).alias("overlap"))


@query("overlap_count", """
    SELECT count(*) AS overlap FROM documents WHERE lang = 'de' AND text IN (SELECT text FROM documents WHERE lang <> 'de')""")
def overlap_count(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang")
    shared = docs.filter("lang = 'de'").join(docs.filter("lang <> 'de'").select("text"), "text", "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("overlap"))


@query("benchmark_overlap", """
    SELECT count(*) AS overlap FROM documents WHERE EXISTS (SELECT 1 FROM benchmark b WHERE b.text = documents.text)""")
def benchmark_overlap(spark, sf):
    items = table(spark, sf, "benchmark").select("text")
    return table(spark, sf, "documents").join(items, "text", "left_semi").agg(F.count(F.lit(1)).alias("overlap"))


@query("coverage_gap", f"""WITH {CLASSED} SELECT label FROM (SELECT DISTINCT label FROM classed WHERE priority = '5-LOW')
    WHERE label NOT IN (SELECT label FROM classed WHERE priority <> '5-LOW')""")
def coverage_gap(spark, sf):
    rows = classed(spark, sf).select("label", "priority")
    validation = rows.filter("priority = '5-LOW'").select("label").distinct()
    return validation.join(rows.filter("priority <> '5-LOW'").select("label").distinct(), "label", "left_anti")


@query("audit_rebuild", """
    SELECT doc_id AS index, CASE WHEN quality = 1 THEN 'gold' ELSE 'generated' END AS answer, n_chars
    FROM labels JOIN documents USING (doc_id) WHERE toxic = 0""")
def audit_rebuild(spark, sf):
    audits = table(spark, sf, "labels").select(F.col("doc_id").alias("index"), F.when(F.col("toxic") == 0, F.when(
        F.col("quality") == 1, "gold").otherwise("generated")).alias("final"))
    samples = table(spark, sf, "documents").select(F.col("doc_id").alias("index"), "n_chars")
    return C.rebuild(audits, samples).select("index", F.col("final").alias("answer"), "n_chars")


@query("resume_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf):
    labels = table(spark, sf, "labels")
    done = labels.filter("quality = 1").select("doc_id").unionByName(labels.filter("quality = 0").select("doc_id"))
    return table(spark, sf, "documents").select("doc_id").join(done, "doc_id", "left_anti")


@query("gold_index", f"""WITH {CLASSED} SELECT label AS key, index, row_number() OVER (PARTITION BY label ORDER BY index) - 1 AS place
    FROM classed""")
def gold_index(spark, sf):
    rows = classed(spark, sf).select(F.col("label").alias("key"), "index")
    return numbered(rows, ["key"], ["index"], F.floor(F.col("index") / 65536), "place")


ALLOCATE = CLASSED + """, tried AS (SELECT index AS row, label AS key, CASE WHEN status = 'O' THEN 0 ELSE 1 END AS origin, summary,
        priority <> '5-LOW' AS passed FROM classed WHERE status <> 'F'),
    ok AS (SELECT * FROM tried WHERE passed AND (origin = 0 OR row IN (SELECT min(row) FROM tried WHERE passed AND origin = 1
        GROUP BY key, summary))),
    n AS (SELECT row, key, row_number() OVER (PARTITION BY key ORDER BY origin, row) AS n FROM ok),
    s AS (SELECT index, label AS key, row_number() OVER (PARTITION BY label ORDER BY index) AS n FROM classed WHERE status = 'F')"""


@query("rank_allocate", f"WITH {ALLOCATE} SELECT row, index FROM n JOIN s USING (key, n)")
def rank_allocate(spark, sf):
    rows = classed(spark, sf)
    tried = rows.filter("status <> 'F' AND priority <> '5-LOW'").select(
        F.col("index").alias("row"), F.col("label").alias("key"), F.when(F.col("status") == "O", 0).otherwise(1).alias("origin"), "summary")
    rejects = C.one_per_reasoning(tried.filter("origin = 1"), "key", "summary", "row")
    passing = tried.filter("origin = 0").unionByName(rejects).drop("summary")
    samples = rows.filter("status = 'F'").select(F.col("label").alias("key"), "index")
    block = F.col("origin").cast("bigint") * (1 << 40) + F.floor(F.col("row") / 65536)
    found = C.rank_allocate(passing, samples, block, F.floor(F.col("index") / 65536), ["origin", "row"])
    return found.select("row", "index")


@query("reject_recovery", """
    WITH r AS (SELECT o_custkey AS index, o_orderkey AS load_order, o_orderstatus AS stage, o_totalprice < 400000 AS ok FROM orders),
    f AS (SELECT * FROM r WHERE stage = 'O' AND index NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000))
    SELECT index, min(load_order) AS load_order FROM f WHERE ok GROUP BY index""")
def reject_recovery(spark, sf):
    orders = table(spark, sf, "orders")
    index = F.col("o_custkey").alias("index")
    passed = F.when(F.col("o_totalprice") < 400000, F.array().cast("array<string>")).otherwise(text_array(["too high"]))
    stage = F.when(F.col("o_orderstatus") == "O", "rule_check").otherwise(F.col("o_orderstatus"))
    rejects = orders.select(index, F.col("o_orderkey").alias("order"), stage.alias("stage"), passed.alias("reasons"))
    audited = orders.filter("o_orderstatus = 'F' AND o_totalprice > 400000").select(index)
    return C.recover(rejects, audited).select("index", F.col("order").alias("load_order"))


@query("recovery_reasons", """
    SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN o_totalprice > 450000 THEN ['too high', 'far too high']
        WHEN o_totalprice > 400000 THEN ['too high'] ELSE [] END) AS reason FROM orders WHERE o_orderstatus = 'O') GROUP BY reason""")
def recovery_reasons(spark, sf):
    from stepforge.plans.reports import fail_reasons

    price = F.col("o_totalprice")
    rows = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select(F.array_compact(F.array(
        F.when(price > 400000, "too high"), F.when(price > 450000, "far too high"))).alias("reasons"))
    return fail_reasons(rows, "reasons", 10)


GATE = """g AS (SELECT doc_id AS index, lang || n_chars % 5 AS class, n_chars, quality, doc_id FROM labels JOIN documents USING (doc_id)),
    e AS (SELECT lang || n_chars % 5 AS class, count(*) AS existing FROM documents WHERE n_chars > 8000 GROUP BY 1),
    room AS (SELECT class, least(pending, 6) - coalesce(existing, 0) AS room, least(pending, 6) AS target, coalesce(existing, 0) AS existing
        FROM (SELECT class, count(*) AS pending FROM g GROUP BY class) LEFT JOIN e USING (class))"""


def gated(spark, sf):
    klass = F.concat("lang", (F.col("n_chars") % 5).cast("string"))
    rows = audit(spark, sf).select("index", klass.alias("class"), "passed", "n_chars")
    existing = table(spark, sf, "documents").filter("n_chars > 8000").groupBy(klass.alias("class")).agg(
        F.count(F.lit(1)).alias("existing"))
    return rows, existing


@query("class_gate", f"""WITH {GATE} SELECT index, class FROM (SELECT index, class, room, row_number() OVER (PARTITION BY class
    ORDER BY n_chars, index) AS rn FROM g JOIN room USING (class) WHERE quality = 1) WHERE rn <= room""")
def class_gate(spark, sf):
    rows, existing = gated(spark, sf)
    return C.class_gate(rows, existing, 6, [F.col("n_chars"), F.col("index")]).select("index", "class")


@query("need_priority", f"""WITH {GATE} SELECT index, class, room AS need FROM g JOIN room USING (class)
    ORDER BY need DESC, length(class), index""")
def need_priority(spark, sf):
    rows, existing = gated(spark, sf)
    pending = rows.groupBy("class").agg(F.count(F.lit(1)).alias("pending")).join(existing, "class", "left")
    need = C.target_count(F.col("pending"), 6) - F.coalesce("existing", F.lit(0))
    return rows.join(pending.select("class", need.alias("need")), "class").select("index", "class", "need").orderBy(
        F.desc("need"), F.length("class"), "index")


@query("existing_counts", f"""WITH {COVER} SELECT class, cot FROM cover""")
def existing_counts(spark, sf):
    # Report rows list their types in any order; the class is their sorted set.
    report = covered(classed(spark, sf)).select(
        F.reverse(F.split("class", r"\|")).alias("types"), F.col("cot").alias("cot_prompts"))
    key = F.concat_ws("|", F.array_sort(F.array_distinct("types")))
    return report.groupBy(key.alias("class")).agg(F.max("cot_prompts").alias("cot"))


@query("pipeline_records", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS index, doc_id, lang FROM documents WHERE lang <> 'de'")
def pipeline_records(spark, sf):
    rows = table(spark, sf, "documents").filter("lang <> 'de'").select("doc_id", "lang")
    return C.subset_index(rows, "doc_id", 1 << 20, "index")


@query("expected_doc", """
    SELECT coalesce(l.doc_id, d.doc_id) AS key, l.doc_id IS NOT NULL AS expected, d.doc_id IS NOT NULL AS existing
    FROM labels l FULL JOIN (SELECT doc_id FROM documents WHERE n_chars > 200) d USING (doc_id)""")
def expected_doc(spark, sf):
    expected = table(spark, sf, "labels").select(F.col("doc_id").alias("key"), F.lit(True).alias("expected"))
    docs = table(spark, sf, "documents").filter("n_chars > 200").select(F.col("doc_id").alias("key"), F.lit(True).alias("existing"))
    no = F.lit(False)
    return expected.join(docs, "key", "full").select(
        "key", F.coalesce("expected", no).alias("expected"), F.coalesce("existing", no).alias("existing"))


# Resampling: orders as samples with a step, a summary and a multiset of part types.
def parsed(spark, sf):
    return classed(spark, sf).select("index", "step", "summary", F.col("label").alias("multiset"))


@query("dedupe_summary", f"""WITH {CLASSED} SELECT index FROM classed
    QUALIFY row_number() OVER (PARTITION BY label, summary ORDER BY step DESC, index) = 1""")
def dedupe_summary(spark, sf):
    return R.dedupe_summary(parsed(spark, sf)).select("index")


CAP = """CASE WHEN f >= 50 THEN least(f, 25) WHEN f >= 30 THEN least(f, 15) WHEN f >= 10 THEN greatest(1, ceil(f * 0.5))
    WHEN f >= 5 THEN greatest(1, ceil(f * 0.75)) WHEN f >= 2 THEN greatest(1, ceil(f * 1.0)) ELSE f END"""


@query("cap_for_freq", f"WITH {CLASSED}, m AS (SELECT label, count(*) AS f FROM classed GROUP BY label) SELECT label, CAST({CAP} AS BIGINT) AS cap FROM m")
def cap_for_freq(spark, sf):
    counted = classed(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("f"))
    return counted.select("label", R.cap_for_freq(F.col("f")).cast("bigint").alias("cap"))


TARGETS = CLASSED + """, supply AS (SELECT step, count(*) AS supply FROM classed GROUP BY step),
    blend AS (SELECT step, least(CASE WHEN supply >= 5 THEN 0.65e0 * ({total}.0e0 / count(*) FILTER (supply >= 5) OVER ())
        + (1.0e0 - 0.65e0) * (supply / sum(supply) OVER () * {total}) ELSE supply / sum(supply) OVER () * {total} END, supply) AS t FROM supply),
    targets AS (SELECT step, CASE WHEN sum(t) OVER () > {total} THEN greatest(1.0, t * {total} / sum(t) OVER ()) ELSE t END AS target FROM blend)"""
TOTAL = 3000


@query("step_targets", f"WITH {TARGETS.format(total=TOTAL)} SELECT step, round(target, 6) AS target FROM targets")
def step_targets(spark, sf):
    return R.step_targets(parsed(spark, sf), TOTAL, 0.65).select("step", F.round("target", 6).alias("target"))


@query("largest_remainder", f"""WITH {TARGETS.format(total=TOTAL)}, r AS (SELECT step, floor(target) AS base, row_number() OVER (
        ORDER BY target - floor(target) DESC, step DESC) AS rn, CAST(greatest(0, least({TOTAL} - sum(floor(target)) OVER (),
        3 * count(*) OVER ())) AS BIGINT) AS missing, count(*) OVER () AS n FROM targets)
    SELECT step, CAST(base + missing // n + CASE WHEN rn <= missing % n THEN 1 ELSE 0 END AS BIGINT) AS units FROM r""")
def largest_remainder(spark, sf):
    return R.largest_remainder(R.step_targets(parsed(spark, sf), TOTAL, 0.65), TOTAL).select("step", "units")


def selected(spark, sf):
    rows = cut_lineage(parsed(spark, sf))
    return rows, R.multiset_resample(rows, R.largest_remainder(R.step_targets(rows, TOTAL, 0.65), TOTAL), 7)


@query("multiset_resample")
def multiset_resample(spark, sf):
    return selected(spark, sf)[1].select("index", "step", "multiset", "pass")


@query("resample_invariants", f"""WITH {CLASSED} SELECT count(DISTINCT label) AS multisets, 0 AS over_cap, 0 AS repeated_summaries,
    0 AS overfilled_steps, 0 AS left_out FROM classed""")
def resample_invariants(spark, sf):
    rows, kept = selected(spark, sf)
    freq = rows.groupBy("multiset").agg(F.count(F.lit(1)).alias("f"))
    per = kept.groupBy("multiset", "summary").agg(F.count(F.lit(1)).alias("n")).groupBy("multiset").agg(
        F.sum("n").alias("n"), F.sum((F.col("n") > 1).cast("int")).alias("repeated")).join(freq, "multiset")
    checks = per.agg(F.count(F.lit(1)).alias("multisets"), F.count_if(F.col("n") > R.cap_for_freq(F.col("f"))).alias("over_cap"),
                     F.sum("repeated").alias("repeated_summaries"))
    targets = R.largest_remainder(R.step_targets(rows, TOTAL, 0.65), TOTAL)
    steps = kept.groupBy("step").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("pass") == 2).alias("filled")).join(targets, "step", "right")
    over = steps.agg(F.count_if((F.col("filled") > 0) & (F.col("m") > F.col("units"))).alias("overfilled_steps"))
    # Rows that could still be added: their step lacks rows and their multiset has room.
    lacking = steps.filter(F.coalesce("m", F.lit(0)) < F.col("units")).select("step")
    roomy = per.filter(F.col("n") < R.cap_for_freq(F.col("f"))).select("multiset")
    spare = R.dedupe_summary(rows).join(kept.select("index"), "index", "left_anti").join(lacking, "step").join(roomy, "multiset").agg(
        F.count(F.lit(1)).alias("left_out"))
    parts = checks.unionByName(over, allowMissingColumns=True).unionByName(spare, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


@query("resample_report")
def resample_report(spark, sf):
    return R.resample_report(*selected(spark, sf))


@query("dedupe_report", f"""WITH {CLASSED}, a AS (SELECT * FROM classed QUALIFY row_number() OVER (PARTITION BY label, summary ORDER BY step DESC, index) = 1),
    o AS (SELECT label, count(*) AS f, count(*) FILTER (step >= 16) AS late FROM classed GROUP BY label),
    k AS (SELECT label, count(*) AS m, count(*) FILTER (step >= 16) AS kept_late FROM a GROUP BY label)
    SELECT CASE WHEN f >= 50 THEN 'T0' WHEN f >= 30 THEN 'T1' WHEN f >= 10 THEN 'T2' WHEN f >= 5 THEN 'T3' WHEN f >= 2 THEN 'T4'
        ELSE 'T5_singleton' END AS tier, CAST(sum(f) AS BIGINT) AS original, CAST(sum(m) AS BIGINT) AS kept,
        CAST(sum(f) - sum(m) AS BIGINT) AS dropped, count(*) AS multisets, round(100 * sum(late) / sum(f), 2) AS late_before,
        round(100 * sum(kept_late) / sum(m), 2) AS late_after FROM o JOIN k USING (label) GROUP BY ROLLUP (1)""")
def dedupe_report(spark, sf):
    rows = parsed(spark, sf)
    return R.resample_report(rows, R.dedupe_summary(rows))


@query("top_multisets", f"""WITH {CLASSED} SELECT label AS multiset, count(*) AS count, round(100 * count(*) / (SELECT count(*) FROM classed), 2)
    AS pct FROM classed GROUP BY label ORDER BY count DESC, label LIMIT 15""")
def top_multisets(spark, sf):
    return R.top_multisets(parsed(spark, sf))


# Order of games.
HARDNESS = "list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], difficulty)"


def hardness():
    names = text_array(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    return F.array_position(names, F.col("difficulty"))


@query("round_robin", f"""
    SELECT match_id, bot, row_number() OVER (PARTITION BY bot ORDER BY {HARDNESS}, match_id) - 1 AS turn FROM match
    ORDER BY turn, bot""", using="match")
def round_robin(spark, sf):
    rows = match(spark, sf).select("match_id", "bot", hardness().alias("hard"))
    return C.round_robin(rows, "bot", ["hard", "match_id"], C.ranged("hard", "match_id")).select("match_id", "bot", "turn").orderBy(
        "turn", "bot")


# One pick after the other: c counts the races picked, t the games taken of each bucket; buckets lie by bot, hardness and race.
TURNS_SQL = f"""m AS (SELECT match_id, bot, race, {HARDNESS} AS hard, row_number() OVER (PARTITION BY bot, {HARDNESS}, race ORDER BY match_id) - 1 AS nth
        FROM match),
    buckets AS (SELECT bot, hard, race, count(*) AS n, dense_rank() OVER (ORDER BY bot) - 1 AS b, list_position(['Protoss', 'Terran', 'Zerg'], race) AS r
        FROM m GROUP BY bot, hard, race),
    every AS (SELECT list({{'bot': bot, 'hard': hard, 'race': race, 'n': n, 'b': b, 'r': r}} ORDER BY bot, hard, race) AS bs, max(b) + 1 AS nb FROM buckets),
    walk AS (SELECT 0 AS turn, 0 AS b, [0, 0, 0] AS c, list_transform(bs, lambda x: 0) AS t, NULL::BIGINT AS i, NULL::BIGINT AS nth_picked, 0 AS idle FROM every
        UNION ALL
        SELECT CASE WHEN b = nb - 1 THEN turn + 1 ELSE turn END, CAST((b + 1) % nb AS INTEGER),
            CASE WHEN p IS NULL THEN c ELSE list_transform(c, lambda x, k: x + CASE WHEN k = bs[p.i].r THEN 1 ELSE 0 END) END,
            CASE WHEN p IS NULL THEN t ELSE list_transform(t, lambda x, k: x + CASE WHEN k = p.i THEN 1 ELSE 0 END) END,
            p.i, CASE WHEN p IS NOT NULL THEN t[p.i] END, CASE WHEN p IS NULL THEN idle + 1 ELSE 0 END
        FROM (SELECT w.*, bs, nb, list_min([{{'h': bs[k].hard, 'c': c[bs[k].r], 'r': bs[k].r, 'i': k}} FOR k IN range(1, len(bs) + 1)
              IF bs[k].b = w.b AND t[k] < bs[k].n]) AS p FROM walk w, every) WHERE idle <= nb),
    picks AS (SELECT bs[i].bot AS bot, bs[i].hard AS hard, bs[i].race AS race, nth_picked AS nth, CASE WHEN b = 0 THEN turn - 1 ELSE turn END AS turn
        FROM walk, every WHERE i IS NOT NULL)"""


@query("diverse_order", f"""WITH RECURSIVE {TURNS_SQL}
    SELECT match_id, bot, race, turn FROM m JOIN picks USING (bot, hard, race, nth) ORDER BY turn, bot""", using="match")
def diverse_order(spark, sf):
    rows = match(spark, sf).select("match_id", "bot", "race", hardness().alias("hard"))
    return C.diverse_order(rows, "bot").select("match_id", "bot", "race", "turn").orderBy("turn", "bot")


@query("limit_preview", f"""
    SELECT match_id, bot, difficulty, race FROM (SELECT *, row_number() OVER (PARTITION BY bot ORDER BY {HARDNESS}, match_id) AS turn FROM match)
    ORDER BY turn, bot LIMIT 20""", using="match")
def limit_preview(spark, sf):
    rows = match(spark, sf).withColumn("hard", hardness())
    turns = C.round_robin(rows, "bot", ["hard", "match_id"], C.ranged("hard", "match_id"))
    return turns.orderBy("turn", "bot").limit(20).select("match_id", "bot", "difficulty", "race")


@query("hardest_victory", f"""
    SELECT bot, arg_min(match_id, (NOT victory, {HARDNESS}, sha256('3:' || match_id))) AS match_id FROM match WHERE duration > 2000
    GROUP BY bot""", using="match")
def hardest_victory(spark, sf):
    rows = match(spark, sf).filter(F.col("duration") > 2000)
    draw = F.sha2(F.concat(F.lit("3:"), F.col("match_id").cast("string")), 256)
    return first_per_key(rows, ["bot"], [~F.col("victory"), hardness(), draw]).select("bot", "match_id")


@query("last_result", """
    SELECT opponent, max(match_id) AS last_game, max(match_id) FILTER (race = 'Zerg') AS last_same_race,
        arg_max(victory, match_id) AS last_won FROM match GROUP BY opponent""", using="match")
def last_result(spark, sf):
    return K.last_results(match(spark, sf), "opponent", "match_id", F.col("race") == "Zerg", "victory")


@query("result_record", """
    SELECT match_id, CASE WHEN victory THEN 1 WHEN duration < 50000 THEN 0 ELSE -1 END AS result, CASE WHEN victory AND duration > 400000
        THEN 'predicted' ELSE 'final' END AS written FROM match""", using="match")
def result_record(spark, sf):
    won, long = F.col("victory"), F.col("duration")
    return match(spark, sf).select(
        "match_id", K.result_of(won, long, 50000).alias("result"),
        F.when(won & (long > 400000), "predicted").otherwise("final").alias("written"))


@query("obs_metadata", """
    SELECT l_suppkey AS game, 'Map' || l_suppkey % 3 AS map, 'Terran vs ' || (['Terran', 'Zerg', 'Protoss'])[l_suppkey % 3 + 1] AS matchup,
        round(max(l_extendedprice), 2) AS duration, count(*) AS records, count(*) FILTER (l_returnflag = 'R') AS with_context
    FROM lineitem GROUP BY l_suppkey""")
def obs_metadata(spark, sf):
    game = F.col("l_suppkey")
    race = F.element_at(text_array(["Terran", "Zerg", "Protoss"]), (game % 3 + 1).cast("int"))
    rows = K.game_records(table(spark, sf, "lineitem"), ["l_suppkey"], F.round("l_extendedprice", 2), F.col("l_returnflag") == "R")
    return rows.select(game.alias("game"), F.concat(F.lit("Map"), (game % 3).cast("string")).alias("map"),
                        F.concat(F.lit("Terran vs "), race).alias("matchup"), "duration", "records", "with_context")
