"""Texts of conversations, documents and candidate lists, read and written."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.plans import rules as R
from stepforge.workload.registry import query
from stepforge.workload.views import cand, cand_lists, sample, sql_list, step, table, text_array, traj_raw

TRIM = "regexp_replace({0}, '\\A\\s+|\\s+\\z', '', 'g')"
KEYS = ["traj_id", "step_id"]


def trim_sql(x):
    return TRIM.format(x)


# Generated texts: a conversation's user text as reasoning and assistant text as answer, in four layouts.
GEN_SQL = """gen AS (SELECT conv_id, coalesce(user_text, '') AS u, coalesce(answer, '') AS a, turns,
    CASE conv_id % 4 WHEN 0 THEN '<think>' || coalesce(user_text, '') || '</think>' || chr(10) || coalesce(answer, '')
        WHEN 1 THEN coalesce(answer, '') WHEN 2 THEN 'x <redacted_thinking id="1">' || coalesce(user_text, '')
            || '</redacted_thinking> ' || coalesce(answer, '')
        ELSE coalesce(answer, '') || '<THINK>' || coalesce(user_text, '') END AS raw FROM sample)"""


def gen(spark, sf):
    rows = sample(spark, sf).select("conv_id", X.or_empty(F.col("user")).alias("u"), X.or_empty(F.col("answer")).alias("a"),
                                    "turns")
    form = F.col("conv_id") % 4
    raw = (F.when(form == 0, F.concat(F.lit("<think>"), "u", F.lit("</think>\n"), "a")).when(form == 1, F.col("a"))
           .when(form == 2, F.concat(F.lit('x <redacted_thinking id="1">'), "u", F.lit("</redacted_thinking> "), "a"))
           .otherwise(F.concat("a", F.lit("<THINK>"), "u")))
    return rows.withColumn("raw", raw)


@query("strip_think", f"""WITH {GEN_SQL} SELECT conv_id, CASE WHEN conv_id % 4 = 0
    THEN regexp_replace(a, '\\A\\s+', '') ELSE raw END AS answer, CASE WHEN conv_id % 4 = 0 THEN {trim_sql('u')} ELSE '' END AS cot
    FROM gen""", using="sample")
def strip_think(spark, sf):
    return gen(spark, sf).select("conv_id", X.strip_think(F.col("raw")).alias("answer"),
                                 X.extract_cot(F.col("raw")).alias("cot"))


@query("split_reasoning", f"""WITH {GEN_SQL} SELECT conv_id,
    CASE WHEN turns > 5 THEN 'field ' || turns WHEN conv_id % 4 = 1 THEN '' ELSE {trim_sql('u')} END AS reasoning,
    CASE WHEN turns > 5 THEN {trim_sql('raw')} WHEN conv_id % 4 = 2 THEN {trim_sql("'x  ' || a")} ELSE {trim_sql('a')} END AS final,
    CASE WHEN turns > 5 THEN 'message.reasoning' WHEN conv_id % 4 = 0 THEN 'content.think' WHEN conv_id % 4 = 1 THEN 'none'
         WHEN conv_id % 4 = 2 THEN 'content.redacted_thinking' ELSE 'content.think.dangling' END AS source FROM gen""",
       using="sample")
def split_reasoning(spark, sf):
    given = F.when(F.col("turns") > 5, F.concat(F.lit(" field "), F.col("turns").cast("string"), F.lit("\n")))
    fields = {"reasoning_content": F.lit(None).cast("string"), "reasoning": given, "reasoning_details": F.lit("")}
    parts = X.split_reasoning(F.col("raw"), fields)
    return gen(spark, sf).select("conv_id", parts.alias("p")).select("conv_id", "p.*")


@query("generated_parts", f"""WITH {GEN_SQL} SELECT conv_id, CASE WHEN turns > 5 THEN 'field' WHEN conv_id % 4 = 0
        THEN {trim_sql('u')} ELSE '' END AS cot, CASE WHEN turns % 2 = 0 THEN 'content' WHEN conv_id % 4 = 0 THEN {trim_sql('a')}
        ELSE {trim_sql('raw')} END AS answer,
    (CASE WHEN turns > 5 THEN 'field' WHEN conv_id % 4 = 0 THEN {trim_sql('u')} ELSE '' END) = '' AS error FROM gen""",
       using="sample")
def generated_parts(spark, sf):
    rows = gen(spark, sf)
    field = F.when(F.col("turns") > 5, F.lit("field"))
    content = F.when(F.col("turns") % 2 == 0, F.lit("content"))
    cot = F.coalesce(field, X.strip(F.regexp_extract("raw", X.THINK, 1)))
    cot = F.when(F.col("conv_id") % 4 == 3, F.coalesce(field, F.lit(""))).otherwise(cot)
    return rows.select("conv_id", cot.alias("cot"), F.coalesce(content, X.answer_text(F.col("raw"))).alias("answer"),
                       (cot == "").alias("error"))


JSON_SQL = """js AS (SELECT conv_id, '{"items": [{"name": "Marine", "count": ' || (turns - 3) || '}, {"name": "SCV", "count": 2}]}'
    AS j, turns - 3 AS n, turns FROM sample)"""


def json_forms(spark, sf):
    rows = sample(spark, sf).withColumn("n", F.col("turns") - 3)
    j = F.concat(F.lit('{"items": [{"name": "Marine", "count": '), F.col("n").cast("string"),
                 F.lit('}, {"name": "SCV", "count": 2}]}'))
    form = F.col("conv_id") % 5
    shown = (F.when(form == 0, j).when(form == 1, F.concat(F.lit(" ```json\n"), j, F.lit("\n``` ")))
             .when(form == 2, F.concat(F.lit("So it is.\nFinal Answer: ```"), j, F.lit("```")))
             .when(form == 3, F.concat(F.lit("I say "), j, F.lit(" and stop"))).otherwise(F.lit(" none here ")))
    return rows.withColumn("j", j).withColumn("shown", shown)


@query("json_candidate", f"""WITH {JSON_SQL} SELECT conv_id, CASE WHEN conv_id % 5 = 4 THEN 'none here' ELSE j END AS json,
    CASE WHEN conv_id % 5 = 4 THEN 'none here' ELSE j[11:-2] END AS list FROM js""", using="sample")
def json_candidate(spark, sf):
    return json_forms(spark, sf).select("conv_id", X.json_candidate(F.col("shown")).alias("json"),
                                        X.json_candidate(F.col("shown"), True).alias("list"))


@query("parse_items", f"""WITH {JSON_SQL} SELECT conv_id, conv_id % 5 = 4 OR n <= 0 AS parse_failed,
    CASE WHEN conv_id % 5 <> 4 AND n > 0 THEN n + 2 END AS total FROM js""", using="sample")
def parse_items(spark, sf):
    items = X.parse_items(X.json_candidate(F.col("shown")))
    total = F.aggregate(items, F.lit(0).cast("bigint"), lambda t, i: t + i["count"])
    return json_forms(spark, sf).select("conv_id", items.isNull().alias("parse_failed"), total.alias("total"))


PROMPT_SQL = """prompts AS (SELECT conv_id, turns, coalesce(user_text, '') AS u FROM sample)"""


def order_prompt(spark, sf):
    rows = sample(spark, sf).withColumn("u", F.regexp_replace(X.or_empty(F.col("user")), r"[\[\]]", ""))
    n = F.col("turns").cast("string")
    return rows.withColumn("prompt", F.concat(
        F.lit("Plan\n[Actions to order]\nBARRACKSTRAIN_marine x "), n, F.lit("\n not an action!\nTERRANBUILD_BARRACKS\n[Notes]\n"),
        "u", F.lit("\n  - BARRACKSTRAIN_MARINE requires TERRANBUILD_BARRACKS first (via Barracks)\n"
                   "attack should come after barrackstrain_marine. tag=7 and Tag = 12, tag=7")))


@query("section", f"WITH {PROMPT_SQL} SELECT conv_id, 'BARRACKSTRAIN_marine x ' || turns || chr(10) || ' not an action!'"
       " || chr(10) || 'TERRANBUILD_BARRACKS' AS body FROM prompts", using="sample")
def section(spark, sf):
    return order_prompt(spark, sf).select("conv_id", X.section(F.col("prompt"), "actions to order").alias("body"))


@query("expand_counts", f"WITH {PROMPT_SQL} SELECT conv_id, repeat('BARRACKSTRAIN_MARINE,', CAST(turns AS INTEGER))"
       " || 'TERRANBUILD_BARRACKS' AS actions FROM prompts", using="sample")
def expand_counts(spark, sf):
    actions = X.expand_counts(X.section(F.col("prompt"), "Actions to order"))
    return order_prompt(spark, sf).select("conv_id", F.concat_ws(",", actions).alias("actions"))


@query("tags_in_text", f"WITH {PROMPT_SQL} SELECT conv_id, '7,12' AS tags FROM prompts", using="sample")
def tags_in_text(spark, sf):
    tags = F.transform(X.tags_in_text(F.col("prompt")), lambda t: t.cast("string"))
    return order_prompt(spark, sf).select("conv_id", F.concat_ws(",", tags).alias("tags"))


@query("prereq_pairs", f"""WITH {PROMPT_SQL} SELECT conv_id,
    'BARRACKSTRAIN_MARINE>TERRANBUILD_BARRACKS,ATTACK>BARRACKSTRAIN_MARINE' AS pairs FROM prompts""", using="sample")
def prereq_pairs(spark, sf):
    pairs = F.transform(X.prereq_pairs(F.col("prompt")), lambda p: F.concat(p["action"], F.lit(">"), p["depends"]))
    return order_prompt(spark, sf).select("conv_id", F.concat_ws(",", pairs).alias("pairs"))


WORDS = ["the ", "ing", "tion", "ent", "er", "ouon", "ene", "la ", "le ", "ch", "ei", "und", "que", "zz"]


@query("name_mentions", f"""
    SELECT doc_id, array_to_string([x FOR x IN {sql_list(WORDS[2:])} IF contains(text, x)], ',') AS names,
        len([x FOR x IN {sql_list(WORDS[2:])} IF contains(text, x)]) > 10 AS failed FROM documents""")
def name_mentions(spark, sf):
    found = X.name_mentions(text_array(WORDS), F.col("text"), text_array(WORDS[:2]))
    return table(spark, sf, "documents").select("doc_id", F.concat_ws(",", found).alias("names"),
                                                (F.size(found) > 10).alias("failed"))


@query("token_mentions", """
    SELECT doc_id, array_to_string(list_sort([x FOR x IN list_distinct(regexp_extract_all(regexp_replace(
        upper(lang) || '_X ' || text || ' ' || upper(source) || ' MARINE_X TOK_' || n_chars,
        '[^\x00-\x7F]', 'z', 'g'), '\\b[A-Z][A-Z0-9_]{3,}\\b'))
        IF x <> 'MARINE_X']), ',') AS tokens FROM documents""")
def token_mentions(spark, sf):
    words = F.concat(F.upper("lang"), F.lit("_X "), "text", F.lit(" "), F.upper("source"), F.lit(" MARINE_X TOK_"),
                     F.col("n_chars").cast("string"))
    found = X.token_mentions(words, F.array(F.lit("MARINE_X")))
    return table(spark, sf, "documents").select("doc_id", F.concat_ws(",", found).alias("tokens"))


STATUS_SQL = """CASE WHEN is_idle THEN 'idle' WHEN quantity > 40 THEN 'busy' ELSE 'busy: TRAIN_X ('
    || CAST(floor(progress * 100) AS BIGINT) || '%)' END || CASE addon WHEN 'techlab' THEN ', has TechLab'
    WHEN 'reactor' THEN ', has Reactor' WHEN 'other' THEN ', has add-on' ELSE CASE WHEN unit = 'BARRACKS'
    THEN ', no add-on' ELSE '' END END"""


def status():
    order = F.when(F.col("quantity") <= 40, F.lit("TRAIN_X"))
    addon = F.when(F.col("addon") == "other", F.lit("thing")).when(F.col("addon") != "none", F.col("addon"))
    return X.candidate_status(F.col("unit"), F.col("is_idle"), order, F.col("progress"), X.or_empty(addon))


@query("candidate_text", f"""
    SELECT prompt, string_agg('  - tag=' || tag % 1000 || ' ' || unit || ' [' || {STATUS_SQL} || ']', chr(10)
        ORDER BY place) AS lines FROM cand_list GROUP BY prompt""", using="cand_list")
def candidate_text(spark, sf):
    return candidate_lists(spark, sf).select("prompt", "lines")


def candidate_lists(spark, sf):
    line = F.concat(F.lit("  - tag="), (F.col("tag") % 1000).cast("string"), F.lit(" "), "unit", F.lit(" ["), status(), F.lit("]"))
    lists = cand_lists(spark, sf, line.alias("text"))
    return lists.withColumn("lines", F.concat_ws("\n", F.transform("l", lambda e: e["text"])))


@query("executor_lines", """
    SELECT prompt, 'TRAIN_X: selected tag ' || arg_min(tag, place) || ' from ' || count(*) || ' candidates.' || chr(10)
        || string_agg('  - tag=' || tag || ' ' || unit || ' [' || CASE WHEN is_idle THEN 'idle' ELSE 'busy' END || ', '
        || CASE addon WHEN 'none' THEN 'no add-on' ELSE addon END || ']', chr(10) ORDER BY place) AS lines
    FROM cand_list GROUP BY prompt""", using="cand_list")
def executor_lines(spark, sf):
    state = F.when(F.col("is_idle"), "idle").otherwise("busy")
    addon = F.when(F.col("addon") == "none", "no add-on").otherwise(F.col("addon"))
    line = F.concat(F.lit("  - tag="), F.col("tag").cast("string"), F.lit(" "), "unit", F.lit(" ["), state, F.lit(", "),
                    addon, F.lit("]"))
    lists = cand_lists(spark, sf, line.alias("text"))
    head = F.concat(F.lit("TRAIN_X: selected tag "), F.col("l")[0]["tag"].cast("string"), F.lit(" from "),
                    F.size("l").cast("string"), F.lit(" candidates."))
    return lists.select("prompt", F.concat_ws("\n", head, F.concat_ws("\n", F.transform(
        "l", lambda e: e["text"]))).alias("lines"))


@query("parse_candidates", """
    SELECT prompt, tag % 1000 AS tag, unit, is_idle AS idle, CASE WHEN NOT is_idle AND quantity <= 40
        THEN floor(progress * 100) / 100 END AS progress, addon, CASE unit WHEN 'ORBITALCOMMAND' THEN 2
        WHEN 'COMMANDCENTER' THEN 1 ELSE 0 END AS tier FROM cand_list""", using="cand_list")
def parse_candidates(spark, sf):
    return candidate_lists(spark, sf).select("prompt", F.inline(X.parse_candidates(F.col("lines"))))


@query("parse_conflicts", f"""
    SELECT conv_id, 'BARRACKSTRAIN_MARINE' AS ability, CASE WHEN turns > 4 THEN '' ELSE 'BUILD_TECHLAB_BARRACKS,UPGRADETOX' END
        AS conflicts FROM sample""", using="sample")
def parse_conflicts(spark, sf):
    rows = sample(spark, sf)
    listed = F.when(F.col("turns") > 4, "(none)").otherwise("  - BUILD_TECHLAB_BARRACKS\n  --UPGRADETOX\n")
    system = F.concat(F.lit("[Ability to execute] BARRACKSTRAIN_MARINE now\n"), X.or_empty(F.col("user")),
                      F.lit("\n[Possible conflicts in pending actions]\n"), listed, F.lit("\n\nOutput ONLY a list"))
    return rows.select("conv_id", F.regexp_extract(system, X.ABILITY, 1).alias("ability"),
                       F.concat_ws(",", X.parse_conflicts(system)).alias("conflicts"))


@query("prompt_tag", """
    SELECT prompt, count(*) > count(DISTINCT tag * 13 % 97) AS collision, string_agg(DISTINCT tag * 13 % 97, ','
        ORDER BY tag * 13 % 97) AS tags FROM cand_list GROUP BY prompt""", using="cand_list")
def prompt_tag(spark, sf):
    alias = F.pmod(F.col("tag") * 13, F.lit(97))
    rows = cand(spark, sf).groupBy("prompt").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(alias)).alias("t"))
    return rows.select("prompt", (F.col("n") > F.size("t")).alias("collision"),
                       F.concat_ws(",", F.transform("t", lambda t: t.cast("string"))).alias("tags"))


@query("answer_tag", """
    SELECT conv_id, CASE conv_id % 4 WHEN 3 THEN NULL WHEN 2 THEN -turns ELSE conv_id END AS tag,
        coalesce(CASE conv_id % 4 WHEN 3 THEN NULL WHEN 2 THEN -turns ELSE conv_id END IN (4, 5, turns, -2, -3), false) AS legal
    FROM sample""", using="sample")
def answer_tag(spark, sf):
    rows = sample(spark, sf)
    form, c = F.col("conv_id") % 4, F.col("conv_id").cast("string")
    text = (F.when(form == 0, F.concat(F.lit("```json\n["), c, F.lit("]\n```"))).when(form == 1, F.concat(F.lit("tag "), c))
            .when(form == 2, F.concat(F.lit(" -"), F.col("turns").cast("string"), F.lit(" or 99"))).otherwise(F.lit("none")))
    tag = X.answer_tag(text)
    legal = F.array(*[F.lit(x).cast("bigint") for x in (4, 5, -2, -3)], F.col("turns"))
    return rows.select("conv_id", tag.alias("tag"), F.coalesce(F.array_contains(legal, tag), F.lit(False)).alias("legal"))


@query("prompt_hash", """
    SELECT doc_id, substring(sha256(text), 1, 16) AS hash FROM documents""")
def prompt_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.prompt_hash(F.col("text")).alias("hash"))


@query("seed_for", """
    SELECT doc_id, CAST('0x' || substring(sha256(doc_id || ':2'), 1, 12) AS BIGINT) AS seed FROM documents""")
def seed_for(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.seed_for(F.col("doc_id"), F.lit(2)).alias("seed"))


@query("gold_key", f"""WITH {JSON_SQL} SELECT conv_id, '[{{"count":' || n || ',"name":"Marine"}},{{"count":2,"name":"SCV"}}]' AS key
    FROM js""", using="sample")
def gold_key(spark, sf):
    # A key is made of what the answer says, also of counts that no sample may have.
    items = F.from_json("j", "struct<items:array<struct<name:string,count:int>>>")["items"]
    fixed = F.transform(items, lambda i: F.struct(i["count"].alias("count"), i["name"].alias("name")))
    return json_forms(spark, sf).select("conv_id", F.to_json(fixed).alias("key"))


@query("sharegpt_render", """
    SELECT conv_id, coalesce(system, '') AS system, coalesce(user_text, '') AS human, '<think>' || chr(10) || turns || chr(10)
        || '</think>' || chr(10) || chr(10) || coalesce(answer, '') AS gpt, coalesce(answer, '') AS nothink FROM sample""",
       using="sample")
def sharegpt_render(spark, sf):
    answer = X.or_empty(F.col("answer"))
    thinking = X.sharegpt(X.or_empty(F.col("system")), X.or_empty(F.col("user")), answer, F.col("turns").cast("string"))
    plain = X.sharegpt(F.lit(""), F.lit(""), answer)
    rows = sample(spark, sf).select("conv_id", thinking.alias("s"), plain.alias("p"))
    return rows.select("conv_id", "s.system", F.col("s.conversations")[0]["value"].alias("human"),
                       F.col("s.conversations")[1]["value"].alias("gpt"), F.col("p.conversations")[1]["value"].alias("nothink"))


@query("chat_to_record", """
    SELECT conv_id, coalesce(user_text, '') AS prompt, coalesce(answer, '') AS answer, 'pipeline' AS source,
           false AS is_last_step FROM sample""", using="sample")
def chat_to_record(spark, sf):
    shown = X.sharegpt(F.lit(""), X.or_empty(F.col("user")), X.or_empty(F.col("answer")), F.lit("why"))["conversations"]
    rows = sample(spark, sf).select("conv_id", shown.alias("c"))
    return rows.select("conv_id", X.turn_value(F.col("c"), "human").alias("prompt"),
                       F.regexp_replace(X.turn_value(F.col("c"), "gpt"), r"(?s)\A<think>.*?</think>\s*?\n\n", "").alias("answer"),
                       F.lit("pipeline").alias("source"), F.lit(False).alias("is_last_step"))


@query("prompt_pull", """
    SELECT conv_id, arg_max(text, turn) FILTER (role = 'system') AS system,
        coalesce(CASE WHEN conv_id % 2 = 0 THEN arg_min(text, turn) FILTER (role = 'user') END,
                 arg_max(text, turn) FILTER (role = 'user')) AS user_text FROM conversations GROUP BY conv_id""")
def prompt_pull(spark, sf):
    # Last and first text per role come from aggregates; a conversation of any length stays spread.
    turns = table(spark, sf, "conversations")
    last = lambda role: F.max_by("text", F.when(F.col("role") == role, F.col("turn")))
    first = F.min_by("text", F.when(F.col("role") == "user", F.col("turn")))
    rows = turns.groupBy("conv_id").agg(last("system").alias("system"), last("user").alias("listed"), first.alias("column"))
    return rows.select("conv_id", "system", F.coalesce(
        F.when(F.col("conv_id") % 2 == 0, F.col("column")), "listed").alias("user_text"))


@query("sample_parts", f"""WITH {GEN_SQL} SELECT conv_id, turns < 3 AS error, u AS user_text,
    CASE conv_id % 4 WHEN 0 THEN {trim_sql('a')} ELSE {trim_sql('raw')} END AS answer FROM gen""", using="sample")
def sample_parts(spark, sf):
    return gen(spark, sf).select("conv_id", (F.col("turns") < 3).alias("error"), F.col("u").alias("user_text"),
                                 X.answer_text(F.col("raw")).alias("answer"))


@query("single_line", f"""
    SELECT doc_id, regexp_replace({trim_sql('text')}, '\\s+', ' ', 'g') AS line FROM documents""")
def single_line(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.single_line(F.col("text")).alias("line"))


def war_text():
    """Whole document with some of its words turned into the wording that is replaced."""
    text = F.col("text")
    for word, other in (("the ", "the first enemy threat "), (" of ", " apply pressure, Second rush; "),
                        ("la ", "scouting enemy threats then Hold ")):
        text = F.regexp_replace(text, word, other)
    return text


@query("no_ordinals")
def no_ordinals(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.no_ordinals(X.single_line(war_text())).alias("line"))


def neutral_sql(text):
    for pattern, replacement, _ in X.NEUTRAL_WORDS:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'gi')"
    return f"regexp_replace({trim_sql(text)}, '\\s+', ' ', 'g')"


WAR_SQL = ("replace(replace(replace(text, 'the ', 'the first enemy threat '), ' of ', ' apply pressure, Second rush; '), "
           "'la ', 'scouting enemy threats then Hold ')")


@query("neutral_words", f"SELECT doc_id, {neutral_sql('t')} AS line FROM (SELECT doc_id, {WAR_SQL} AS t FROM documents)")
def neutral_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.neutral_words(war_text()).alias("line"))


@query("closing_line", f"""WITH l AS (SELECT conv_id, turns, array_to_string([x FOR x IN [{trim_sql('y')} FOR y IN
        string_split(coalesce(answer, ''), chr(10))] IF x <> ''], ' ') AS body FROM sample)
    SELECT conv_id, CASE WHEN body = '' THEN '[Step ' || turns || '] {X.CLOSINGS[0]}'
        WHEN conv_id % 3 = 0 THEN '[Step 2] ' || body || ' {X.CLOSINGS[1]}' ELSE '[Step ' || turns || '] ' || body
        || ' {X.CLOSINGS[0]}' END AS line FROM l""", using="sample")
def closing_line(spark, sf):
    body = X.or_empty(F.col("answer"))
    shown = F.when((F.col("conv_id") % 3 == 0) & (X.strip(body) != ""), F.concat(
        F.lit("[Step 2] "), F.regexp_replace(body, r"\A\s+", ""), F.lit("\n " + X.CLOSINGS[1] + "\n"))).otherwise(body)
    return sample(spark, sf).select("conv_id", X.closing_line(shown, F.col("turns")).alias("line"))


@query("tech_requirements", """
    SELECT event_id, CASE WHEN needs IS NULL THEN '' ELSE needs || '/' || coalesce(needs_action, '-') END AS requirements
    FROM traj JOIN ability USING (ability) WHERE result IS NOT NULL""", using="traj ability")
def tech_requirements(spark, sf):
    from stepforge.workload.graph_rows import graph

    rows = traj_raw(spark, sf).join(graph(spark, "ability"), "ability").filter(F.col("result").isNotNull())
    made = F.when(F.col("needs_action").isNull(), "").otherwise(F.concat(F.lit(" ("), "needs_action", F.lit(")")))
    branch = F.when(F.col("needs").isNull(), "").otherwise(F.concat(F.lit("[Base -> "), "needs", made, F.lit("] ")))
    chain = F.concat("result", F.lit(": "), branch, F.lit("-> "), "result", F.lit(" ("), "ability", F.lit(")"))
    chains = F.array(F.lit("Other: [Wrong] -> Other (OTHER_ACTION)"), chain)
    found = F.transform(X.tech_requirements(chains, F.col("ability")), lambda r: F.concat_ws(
        "/", r["entity"], F.coalesce(r["action"], F.lit("-"))))
    return rows.select("event_id", F.concat_ws(",", found).alias("requirements"))


@query("model_rank", """
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '4b' WHEN 1 THEN '4b' WHEN 2 THEN '32b' ELSE '32b' END AS rank FROM documents""")
def model_rank(spark, sf):
    names = text_array(["Qwen-4B", "qwen-14b", "qwen-32b", ""])
    key = F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", X.model_rank(key, F.lit("32b")).alias("rank"))


@query("scan_step_docs", """
    SELECT doc_id, number, line FROM (SELECT doc_id, i % 5 AS number, '[Step ' || i % 5 || '] ' || x AS line, row_number()
        OVER (PARTITION BY doc_id, i % 5 ORDER BY i DESC) AS rn FROM (SELECT doc_id, regexp_replace(unnest(string_split(
            text, chr(10))), '\\A\\s+|\\s+\\z', '', 'g') AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM documents) WHERE x <> '') WHERE rn = 1""")
def scan_step_docs(spark, sf):
    from stepforge.sources.files import parse_step_lines

    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "x"))
    lines = lines.filter(X.strip(F.col("x")) != "").withColumn("at", F.col("at") + 1)
    number = (F.col("at") % 5).cast("string")
    text = F.concat(F.lit(" [Step "), number, F.lit("] "), F.regexp_replace("x", r"\A\s+", ""))
    return parse_step_lines(lines.select("doc_id", "at", text.alias("value")), ["doc_id"]).select(
        "doc_id", F.col("number").cast("bigint").alias("number"), "line")


@query("doc_summary", f"""
    SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN '' ELSE {trim_sql("replace(text, '#', '')")} END AS summary FROM documents""")
def doc_summary(spark, sf):
    text = F.regexp_replace("text", "#", "")
    form = F.col("doc_id") % 3
    doc = (F.when(form == 0, F.concat(F.lit("# Summary\n"), text, F.lit("\n# Details\n[Step 1] go")))
           .when(form == 1, F.concat(F.lit("head\n# Summary  "), text)).otherwise(text))
    return table(spark, sf, "documents").select("doc_id", X.strip(F.regexp_extract(doc, X.SUMMARY, 1)).alias("summary"))


@query("doc_valid", "SELECT doc_id, contains(text, 'the ') AS valid FROM documents")
def doc_valid(spark, sf):
    mark = "*(LLM call failed)*"
    text = F.concat("text", F.when(F.contains("text", F.lit("the ")), F.lit("")).otherwise(F.lit(mark)))
    return table(spark, sf, "documents").select("doc_id", (~F.contains(text, F.lit(mark))).alias("valid"))


@query("upgrade_list", """
    SELECT traj_id, coalesce(string_agg(DISTINCT upper(event_type) || k % 3, ',' ORDER BY upper(event_type) || k % 3)
        FILTER (upper(event_type) || k % 3 NOT IN ('VIEW0', 'CLICK2')), '') AS upgrades FROM traj GROUP BY traj_id""", using="traj")
def upgrade_list(spark, sf):
    name = F.concat(F.upper("event_type"), (F.col("k") % 3).cast("string"))
    rows = traj_raw(spark, sf).groupBy("traj_id").agg(F.collect_set(name).alias("u"))
    return rows.select("traj_id", F.concat_ws(",", F.array_sort(F.array_except(
        "u", text_array(["VIEW0", "CLICK2"])))).alias("upgrades"))


@query("obs_render", """
    WITH c AS (SELECT traj_id, ability, count(*) AS n FROM traj GROUP BY ALL),
    q AS (SELECT traj_id, event_type, count(*) AS n FROM traj WHERE event_type IN ('view', 'click') GROUP BY ALL),
    o AS (SELECT traj_id, string_agg(n || ' ' || ability, ', ' ORDER BY n DESC, ability) AS built FROM c GROUP BY traj_id),
    s AS (SELECT traj_id, string_agg(CASE event_type WHEN 'view' THEN 'Training ' || n || ' VIEW' ELSE 'Researching CLICK' END,
        ', ' ORDER BY n DESC, CASE event_type WHEN 'view' THEN 'Training VIEW' ELSE 'Researching CLICK' END) AS queues
        FROM q GROUP BY traj_id),
    m AS (SELECT traj_id, max(k) AS k, count(*) AS n, round(sum(value), 2) AS v FROM traj GROUP BY traj_id)
    SELECT traj_id, array_to_string(['[Time] ' || k || ':00 (' || k * 60 || '.0s).',
        '[Economy] ' || n || ' minerals, ' || k || ' vespene; income ' || n * 10 || ' mins/min, ' || k * 10 || ' gas/min. Supply: '
        || n || '/200 (workers ' || k || '/66 current/ideal, army ' || n || ').',
        '[Own Forces & Infrastructure]', '  Completed: ' || built || '.', '  Under Construction: none.',
        '  Workers En Route: none.', '  Active Queues: ' || coalesce(queues, 'none') || '.',
        '[Enemy Intelligence] nothing scouted yet.',
        '[Map Control] 2 own bases, 1 known enemy bases, 9 neutral expansions remaining.',
        '[Combat Analysis] army advantage = Even, income advantage = Even, predicted = Even. Power: ' || n || ' vs ' || k
        || '. Losses: own 0 minerals/0 gas, enemy 0 minerals/0 gas.',
        '[Research & Technology] none.', CASE WHEN k > 95 THEN '[Threat Flags] enemy rush detected (Pool12); '
        || 'enemy cloak/burrow threat detected.' ELSE '[Threat Flags] none.' END], chr(10)) AS obs
    FROM m JOIN o USING (traj_id) LEFT JOIN s USING (traj_id)""", using="traj")
def obs_render(spark, sf):
    from stepforge.plans.observe import render_observation

    snapshot = observed(spark, sf)
    return snapshot.select("traj_id", render_observation(F.col("snapshot")).alias("obs"))


def observed(spark, sf):
    """A snapshot struct per trajectory, put together from aggregates."""
    from stepforge.plans.observe import snapshot

    rows = traj_raw(spark, sf)

    def as_map(df, name):
        counted = df.groupBy("traj_id", name).agg(F.count(F.lit(1)).alias("n"))
        return counted.groupBy("traj_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias("m"))

    queue = F.when(F.col("event_type") == "view", "Training VIEW").when(F.col("event_type") == "click", "Researching CLICK")
    queued = rows.withColumn("q", queue).filter(F.col("q").isNotNull())
    base = rows.groupBy("traj_id").agg(F.max("k").alias("k"), F.count(F.lit(1)).alias("n"))
    built, queues = as_map(rows, "ability"), as_map(queued, "q").withColumnRenamed("m", "queues")
    joined = base.join(built, "traj_id").join(queues, "traj_id", "left")
    none = F.create_map().cast("map<string,bigint>")
    return joined.select("traj_id", "k", "n", snapshot(
        time=F.col("k") * 60.0, minerals=F.col("n"), vespene=F.col("k"), mineral_rate=F.col("n") * 10.0,
        gas_rate=F.col("k") * 10.0, supply_used=F.col("n"), supply_cap=F.lit(200), workers=F.col("k"), ideal=F.lit(66),
        army=F.col("n"), completed=F.col("m"), building=none, en_route=none, queues=F.coalesce("queues", none), enemy=none,
        bases=F.array(F.lit(2), F.lit(1), F.lit(9)), advantages=text_array(["Even", "Even", "Even"]), own_power=F.col("n") * 1.0,
        enemy_power=F.col("k") * 1.0, losses=F.array(*[F.lit(0)] * 4), upgrades=F.array().cast("array<string>"),
        rush=F.when(F.col("k") > 95, "Pool12"), macro=F.lit("StandardMacro"), proxy=F.lit(False),
        cloak=F.col("k") > 95).alias("snapshot"))


@query("obs_snapshot", """
    SELECT traj_id, max(k) * 60.0 AS time, count(*) AS supply_used, count(DISTINCT ability) AS kinds,
           max(k) > 95 AS rushing FROM traj GROUP BY traj_id""", using="traj")
def obs_snapshot(spark, sf):
    rows = observed(spark, sf)
    return rows.select("traj_id", "snapshot.time", "snapshot.economy.supply_used",
                       F.size("snapshot.own_forces.completed").cast("bigint").alias("kinds"),
                       F.col("snapshot.memory_flags.rush_build").isNotNull().alias("rushing"))


# Rule checks: the answer is generated from the sample with one kind of fault per remainder.
CANON = ["Marine", "SCV", "Barracks", "Marauder", "Reaper", "Factory", "Hellion", "Starport", "Medivac", "Banshee", "Raven",
         "Viking", "Ghost", "Thor", "Cyclone"]


@query("rule_naming", """
    SELECT conv_id, array_to_string([x FOR x IN [CASE WHEN conv_id % 5 = 0 THEN 'missing gold types: SCV' END,
        CASE WHEN conv_id % 5 = 1 THEN 'non-canonical names: Wizard' END,
        CASE WHEN conv_id % 5 <> 2 AND turns * 2 + CASE WHEN conv_id % 5 = 0 THEN 0 WHEN conv_id % 5 = 1 THEN 3 ELSE 2 END
            NOT BETWEEN 5 AND 15 THEN 'total must be 5-15, got '
            || (turns * 2 + CASE WHEN conv_id % 5 = 0 THEN 0 WHEN conv_id % 5 = 1 THEN 3 ELSE 2 END) END,
        CASE WHEN conv_id % 5 = 2 THEN 'parse_failed' END,
        CASE WHEN conv_id % 5 = 3 THEN 'reasoning mentions many other names' END] IF x IS NOT NULL], '; ') AS reasons
    FROM sample""", using="sample")
def rule_naming(spark, sf):
    form, n = F.col("conv_id") % 5, (F.col("turns") * 2).cast("string")
    gold = X.parse_items(F.lit('{"items": [{"name": "Marine", "count": 3}, {"name": "SCV", "count": 2}]}'))
    tail = (F.when(form == 0, "").when(form == 1, ', {"name": "SCV", "count": 2}, {"name": "Wizard", "count": 1}')
            .when(form == 2, ', {"name": "", "count": 2}').otherwise(', {"name": "SCV", "count": 2}'))
    generated = X.parse_items(F.concat(F.lit('{"items": [{"name": "Marine", "count": '), n, F.lit("}"), tail, F.lit("]}")))
    cot = F.when(form == 3, " ".join(CANON)).otherwise("Marine and Ghost")
    reasons = R.rule_naming(gold, generated, cot, text_array(CANON))
    return sample(spark, sf).select("conv_id", F.concat_ws("; ", reasons).alias("reasons"))


@query("rule_ordering", """
    SELECT conv_id, CASE conv_id % 5 WHEN 4 THEN 'parse_failed' ELSE array_to_string([x FOR x IN [
        CASE WHEN conv_id % 5 = 1 THEN 'action count differs' END,
        CASE WHEN conv_id % 5 IN (1, 2) THEN 'action multiset differs from gold' END,
        CASE WHEN turns <> 3 THEN 'input multiset differs from gold' END,
        CASE WHEN conv_id % 5 = 3 THEN 'TERRANBUILD_BARRACKS must come before BARRACKSTRAIN_MARINE' END] IF x IS NOT NULL],
        '; ') END AS reasons FROM sample""", using="sample")
def rule_ordering(spark, sf):
    def order(*names):
        return X.actions_json(text_array(names))

    b, m = "TERRANBUILD_BARRACKS", "BARRACKSTRAIN_MARINE"
    form = F.col("conv_id") % 5
    answer = (F.when(form == 1, order(b, m)).when(form == 2, order(b, m, m, "ATTACK")).when(form == 3, order(m, b, m, m))
              .when(form == 4, F.lit("[]")).otherwise(order(b, m, m, m)))
    reasons = R.rule_ordering(F.col("prompt"), X.parse_ordered(order(b, m, m, m)), X.parse_ordered(answer), F.lit("ok"))
    return order_prompt(spark, sf).select("conv_id", F.concat_ws("; ", reasons).alias("reasons"))


@query("rule_executor", """
    SELECT prompt, CASE WHEN prompt % 4 = 3 THEN 'parse_failed' ELSE array_to_string([x FOR x IN [
        CASE WHEN prompt % 4 = 1 THEN 'tag is not a candidate' END,
        CASE WHEN prompt % 4 IN (1, 2) THEN 'reasoning names other tags' END] IF x IS NOT NULL], '; ') END AS reasons
    FROM cand_list GROUP BY prompt""", using="cand_list")
def rule_executor(spark, sf):
    rows = candidate_lists(spark, sf)
    form, first = F.col("prompt") % 4, (F.col("l")[0]["tag"] % 1000).cast("string")
    answer = F.when(form == 1, F.lit("[77777]")).when(form == 3, F.lit("[1, 2]")).otherwise(
        F.concat(F.lit("["), first, F.lit("]")))
    cot = F.when(form.isin(1, 2), F.lit("tag=55555 is idle")).otherwise(F.concat(F.lit("tag="), first))
    reasons = R.rule_executor(F.col("lines"), F.col("l")[0]["tag"], X.parse_tags(answer), cot)
    return rows.select("prompt", F.concat_ws("; ", reasons).alias("reasons"))


@query("set_rules", """
    WITH a AS (SELECT l_orderkey AS o, list_sort(list(DISTINCT p_type) FILTER (l_returnflag <> 'R')) AS gold,
        list_sort(list(DISTINCT p_type) FILTER (l_linestatus = 'O')) AS made FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY l_orderkey)
    SELECT o, array_to_string([x FOR x IN coalesce(gold, []) IF NOT list_contains(coalesce(made, []), x)], ',') AS missing,
        array_to_string([x FOR x IN coalesce(made, []) IF x NOT IN ('SMALL', 'LARGE', 'PROMO')], ',') AS unknown FROM a""")
def set_rules(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rows = table(spark, sf, "lineitem").join(parts, "l_partkey")
    made = rows.groupBy(F.col("l_orderkey").alias("o")).agg(
        F.collect_set(F.when(F.col("l_returnflag") != "R", F.col("p_type"))).alias("gold"),
        F.collect_set(F.when(F.col("l_linestatus") == "O", F.col("p_type"))).alias("made"))
    missing, unknown = F.array_except("gold", "made"), F.array_except("made", text_array(["SMALL", "LARGE", "PROMO"]))
    return made.select("o", F.concat_ws(",", F.array_sort(missing)).alias("missing"),
                       F.concat_ws(",", F.array_sort(unknown)).alias("unknown"))
