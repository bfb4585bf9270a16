"""Column expressions that read and write the texts of samples and steps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the text formats.
THINK = r"(?is)<think\b[^>]*>(.*?)</think>"
THINK_OPEN = r"(?is)<think\b[^>]*>(.*)\z"
REDACTED = r"(?is)<redacted_thinking\b[^>]*>(.*?)</redacted_thinking>"
REDACTED_OPEN = r"(?is)<redacted_thinking\b[^>]*>(.*)\z"
FENCE = r"(?is)\A```(?:json)?\s*(.*?)```\z"
ANSWER_LABEL = r"(?is)\A.*?(?:\A|\n)\s*(?:FINAL_ANSWER|Final Answer|Answer)\s*:\s*"
JSON_OBJECT = r"(?s)\{.*\}"
JSON_ARRAY = r"(?s)\[.*\]"
ACTION_COUNT = r"(?im)^\s*([A-Z0-9_]+)(?:\s*x\s*(\d+))?\s*$"
TAG = r"(?iU)\btag\s*=\s*(\d+)\b"
REQUIRES = r"(?iU)\b([A-Z0-9_]+)\s+requires\s+([A-Z0-9_]+)\s+first\b"
COMES_AFTER = r"(?iU)\b([A-Z0-9_]+)\s+should\s+come\s+after\s+([A-Z0-9_]+)\b"
ACTION_TOKEN = r"(?U)\b[A-Z][A-Z0-9_]{3,}\b"
CANDIDATE = r"(?m)^\s*-\s*tag=(\d+)\s+(\S+)\s+\[(.+)\]\s*$"
ABILITY = r"\[Ability to execute\]\s*(\S+)"
BUSY_PROGRESS = r"(?i)busy:.*?\((\d+)%\)"
STEP_LINE = r"^\[Step\s+(\d+)\]\s*(.*)$"
SUMMARY = r"(?sm)^# Summary\s*(.*?)(?:^# Details\s*|\z)"

# Counted words and what replaces them.
ORDINALS_TO_A = ["first", "1st"]
ORDINALS_TO_ANOTHER = ["second", "2nd", "third", "3rd", "fourth", "4th", "fifth", "5th", "sixth", "seventh", "eighth",
                       "ninth", "tenth"]
# Repairs after the words were replaced, in order.
ORDINAL_REPAIRS = [
    (r"\bthe\s+a\s+(?!one\b)", "a "),
    (r"\b(your|my|our|their)\s+a\s+(?!one\b)", "$1 "),
    (r"\ba\s+another\b", "another"),
    (r"\bthe\s+another\b", "another"),
    (r"\bthe\s+a\s+one\b", "an existing one"),
    (r"\bthe\s+another\s+one\b", "another one"),
    (r"(?<!-)\bnext one\b(?!-)", "another one"),
]
# Wording about the enemy, its neutral form, and a part that any match contains, in order.
NEUTRAL_WORDS = [
    (r"\bscout(?:ing)?\s+enemy\s+threats?\b", "read the map state", "threat"),
    (r"\benemy\s+threats?\b", "map-state options", "threat"),
    (r"\bto\s+pressure\s+the\s+game\b", "to add mobile map presence", "pressure"),
    (r"\bapply\s+pressure\b", "add production tempo", "pressure"),
    (r"\bcloaked\s+harassers\b", "cloaked tech units", "harassers"),
    (r"\bharassers\b", "mobile units", "harassers"),
    (r"\bharasser\b", "mobile unit", "harasser"),
    (r"\bcloaked\s+harass(?:ment)?\s+units\b", "cloaked tech units", "harass"),
    (r"\bharass(?:ment)?\s+units\b", "mobile units", "harass"),
    (r"\bharrassment\s+units\b", "mobile units", "harrassment"),
    (r"\bharassment\b", "mobile map presence", "harassment"),
    (r"\bharrassment\b", "mobile map presence", "harrassment"),
    (r"\bharass\b", "apply mobile map presence", "harass"),
    (r"\bharassing\b", "using mobile map presence", "harassing"),
    (r"\bpressure\b", "production tempo", "pressure"),
    (r"\bthreats\b", "options", "threats"),
    (r"\bthreat\b", "option", "threat"),
    (r"\brushes\b", "fast timings", "rushes"),
    (r"\brush\b", "fast timing", "rush"),
    (r"\bscouting\b", "vision", "scouting"),
    (r"\bscout\b", "vision", "scout"),
    (r"\benemy\b", "map", "enemy"),
    (r"\bopponents\b", "games", "opponents"),
    (r"\bopponent\b", "game", "opponent"),
    (r"\bmove-out\b", "advance", "move-out"),
    (r"\bmove out\b", "advance", "move out"),
    (r"\bpoke\b", "small advance", "poke"),
    (r"\bhold\b", "stabilize", "hold"),
    (r"\bapply mobile map presence production tempo\b", "add mobile map presence", "mobile map presence"),
    (r"\bmobile map presence production tempo\b", "mobile map presence", "mobile map presence"),
]
# Closing sentences of a final step.
CLOSINGS = [
    "Use this gameplan as your strategic baseline -- adapt your decisions based on what you scout and how the game unfolds.",
    "Use this gameplayplan as your strategic baseline -- adapt your decisions based on what you scout and how the game unfolds.",
]
# Difficulties from hardest to easiest, and races.
DIFFICULTIES = ["veryhard", "harder", "hard", "mediumhard", "medium", "easy", "veryeasy"]
RACES = ["zerg", "protoss", "terran"]


def strip(text: Column) -> Column:
    """Without white space at both ends, line ends included."""
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def bind(values: Column, use) -> Column:
    """``use`` of a struct whose fields are worked out once."""
    return F.transform(F.array(values), use)[0]


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.when(F.rlike(text, F.lit(pattern)), F.regexp_extract(text, pattern, group))


def cut_first(text: Column, pattern: str) -> Column:
    """The text without the pattern's first match."""
    piece = F.regexp_extract(text, pattern, 0)
    at = F.instr(text, piece)
    return F.when(piece == "", text).otherwise(F.concat(
        F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(piece), F.length(text))))


def strip_think(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<think>.*?</think>\s*", "")


def extract_cot(text: Column) -> Column:
    return strip(F.regexp_extract(text, r"(?s)<think>\s*(.*?)\s*</think>", 1))


def answer_text(text: Column) -> Column:
    """The assistant's text without its reasoning block."""
    return strip(cut_first(or_empty(text), THINK))


def split_reasoning(content: Column, fields: dict[str, Column], mode: str = "auto") -> Column:
    """Struct (reasoning, final, source). ``fields`` names message columns in the order they are tried.

    Modes: auto, none, a field's name, think_tags, redacted_thinking_tags.
    """
    text = or_empty(content)

    def result(reasoning, final, source):
        return F.struct(reasoning.alias("reasoning"), strip(final).alias("final"), F.lit(source).alias("source"))

    def from_field(name):
        value = strip(or_empty(fields[name]))
        return F.when(value != "", result(value, text, f"message.{name}"))

    def from_tags(block, opened, source):
        closed = F.rlike(text, F.lit(block))
        rest = F.regexp_extract(text, opened, 0)
        before = F.substring(text, F.lit(1), F.length(text) - F.length(rest))
        return F.when(closed, result(strip(F.regexp_extract(text, block, 1)), cut_first(text, block), source)).when(
            F.rlike(text, F.lit(opened)), result(strip(F.regexp_extract(text, opened, 1)), before, f"{source}.dangling"))

    tries = {name: from_field(name) for name in fields}
    tries["think_tags"] = from_tags(THINK, THINK_OPEN, "content.think")
    tries["redacted_thinking_tags"] = from_tags(REDACTED, REDACTED_OPEN, "content.redacted_thinking")
    nothing = result(F.lit(""), text, "none")
    if mode == "none":
        return nothing
    wanted = list(tries.values()) if mode == "auto" else [tries[mode]]
    return F.coalesce(*wanted, nothing)


def unfence(text: Column) -> Column:
    bare = strip(or_empty(text))
    return F.coalesce(strip(found(bare, FENCE)), bare)


def json_candidate(text: Column, prefer_array: bool = False) -> Column:
    """The part of an answer most likely to be its JSON."""
    bare = unfence(strip(F.regexp_replace(unfence(text), ANSWER_LABEL, "")))
    tries = [found(bare, JSON_OBJECT, 0), found(bare, JSON_ARRAY, 0)]
    return F.coalesce(*([tries[1], tries[0]] if prefer_array else tries), bare)


def one_json(json: Column) -> Column:
    """The text as one JSON value, null if it is none or something follows it; an object that repeats a key is none."""
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), json, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(alone) == 1, alone[0])


def whole_number(value: Column) -> Column:
    """The integer that a JSON value stands for, null if none.

    Numbers are cut, true is 1 and false 0; a string must be an integer in
    digits, with a sign, white space around it or underscores between digits.
    """
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    digits = F.when(F.rlike(text, F.lit(r"\A\s*[+-]?\d+(_\d+)*\s*\z")), F.regexp_replace(text, r"[\s_]", "").try_cast("bigint"))
    number = F.try_variant_get(value, "$", "double")
    return (F.when(kind == "STRING", digits).when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast("bigint"))
            .when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
            .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("bigint")))


def name_of(value: Column) -> Column:
    """A JSON value as a name: what counts as false or nothing is empty, lists and objects are their JSON text."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    named = F.when(kind == "BOOLEAN", F.when(text == "true", "True")).when(F.rlike(text, F.lit(r"\A(-?0(\.0+)?|\[\]|\{\})\z")) & (kind != "STRING"), "").otherwise(text)
    return F.coalesce(named, F.lit(""))


def parse_items(json: Column) -> Column:
    """Item list of an answer; null if it is not one, an item has no name or no positive count, or text follows it."""
    items = F.try_variant_get(one_json(json), "$.items", "array<variant>")
    part = lambda i, name: F.try_variant_get(i, f"$.{name}", "variant")
    read = F.transform(items, lambda i: F.struct(name_of(part(i, "name")).alias("name"), whole_number(part(i, "count")).alias("count")))
    good = F.forall(read, lambda i: (i["name"] != "") & (F.coalesce(i["count"], F.lit(0)) > 0))
    return F.when(read.isNotNull() & good, read)


def parse_ordered(json: Column) -> Column:
    actions = F.from_json(json, "struct<ordered_actions:array<string>>")["ordered_actions"]
    return F.when(F.forall(actions, lambda a: F.coalesce(a, F.lit("")) != ""), actions)


def parse_tags(json: Column) -> Column:
    """The one tag of an executor answer; a bare number counts as a list of one."""
    value = one_json(json)
    bare = F.rlike(json, F.lit(r"\A\s*-?\d+\s*\z"))
    tags = F.when(bare, F.array(value)).otherwise(F.try_variant_get(value, "$", "array<variant>"))
    return F.when(F.size(tags) == 1, whole_number(tags[0]))


def section(text: Column, heading: str) -> Column:
    """Body after ``[heading]`` up to the next ``[..]`` line."""
    pattern = r"(?is)\[" + _literal(heading) + r"\]\s*(.*?)(?=\n\[[^\]]+\]|\z)"
    return strip(F.regexp_extract(text, pattern, 1))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in text)


def expand_counts(body: Column) -> Column:
    """``A x N`` lines as the upper-cased action N times."""
    names = F.regexp_extract_all(body, F.lit(ACTION_COUNT), F.lit(1))
    times = F.regexp_extract_all(body, F.lit(ACTION_COUNT), F.lit(2))
    return F.flatten(F.zip_with(names, times, lambda n, t: F.array_repeat(
        F.upper(n), F.when(t == "", 1).otherwise(t.cast("int")))))


def tags_in_text(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), lambda t: t.cast("bigint")))


def prereq_pairs(text: Column) -> Column:
    """Distinct (action, depends) pairs that a prompt states, in both wordings."""
    def pairs(pattern):
        actions = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        depends = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        return F.zip_with(actions, depends, lambda a, d: F.struct(F.upper(a).alias("action"), F.upper(d).alias("depends")))

    return F.array_distinct(F.concat(pairs(REQUIRES), pairs(COMES_AFTER)))


def name_mentions(names: Column, text: Column, excluded: Column) -> Column:
    """Names that occur in the text and are not excluded."""
    return F.filter(F.array_except(names, excluded), lambda n: F.contains(text, n))


def token_mentions(text: Column, known: Column) -> Column:
    return F.array_sort(F.array_except(F.regexp_extract_all(text, F.lit(ACTION_TOKEN), F.lit(0)), known))


def addon_kind(status: Column) -> Column:
    low = F.lower(status)
    return (F.when(F.contains(low, F.lit("has reactor")), "reactor").when(F.contains(low, F.lit("has techlab")), "techlab")
            .when(F.contains(low, F.lit("has add-on")), "other").otherwise("none"))


def base_tier(unit: Column) -> Column:
    return F.when(unit.isin("ORBITALCOMMAND", "PLANETARYFORTRESS"), 2).when(unit == "COMMANDCENTER", 1).otherwise(0)


def parse_candidates(text: Column) -> Column:
    """Candidates of a prompt as an array of (tag, unit, idle, progress, addon, tier); the text is worked out once."""
    def candidate(r):
        return F.struct(
            r["tag"].cast("bigint").alias("tag"), r["unit"].alias("unit"), F.rlike(r["status"], F.lit(r"\A\s*idle")).alias("idle"),
            (found(r["status"], BUSY_PROGRESS).cast("int") / 100).alias("progress"), addon_kind(r["status"]).alias("addon"),
            base_tier(r["unit"]).alias("tier"))

    def rows(t):
        def group(number):
            return F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(number))

        return F.transform(F.arrays_zip(group(1).alias("tag"), group(2).alias("unit"), group(3).alias("status")), candidate)

    return bind(text, rows)


def parse_conflicts(text: Column, heading: str = "Possible conflicts in pending actions") -> Column:
    """Actions listed under the heading, without the ``(none)`` mark."""
    body = F.regexp_extract(text, r"(?s)\[" + _literal(heading) + r"\]\s*\n(.*?)(?:\n\nOutput|\z)", 1)
    lines = F.transform(F.split(body, "\n"), lambda x: strip(F.regexp_replace(strip(x), r"\A-+", "")))
    return F.filter(lines, lambda x: (x != "") & (x != "(none)"))


def candidate_status(unit: Column, idle: Column, order: Column, progress: Column, addon: Column) -> Column:
    """``idle`` or ``busy..`` and the add-on phrase; a percentage is cut, not rounded."""
    percent = F.floor(progress * 100).cast("string")
    busy = (F.when(order.isNull(), F.lit("busy")).when(progress.isNull(), F.concat(F.lit("busy: "), order))
            .otherwise(F.concat(F.lit("busy: "), order, F.lit(" ("), percent, F.lit("%)"))))
    upper = F.upper(addon)
    extra = (F.when(F.contains(upper, F.lit("TECHLAB")), "has TechLab").when(F.contains(upper, F.lit("REACTOR")), "has Reactor")
             .when(upper != "", "has add-on").when(unit.isin("BARRACKS", "FACTORY", "STARPORT"), "no add-on"))
    return F.concat_ws(", ", F.when(idle, F.lit("idle")).otherwise(busy), extra)


def answer_tag(text: Column) -> Column:
    """First integer of an answer without its code fence."""
    bare = strip(or_empty(text))
    inner = F.when(bare.startswith("```"), strip(F.regexp_replace(F.regexp_replace(
        bare, r"\A```[a-zA-Z]*\s*", ""), r"\s*```\z", ""))).otherwise(bare)
    return found(inner, r"-?\d+", 0).cast("bigint")


def prompt_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def seed_for(sample: Column, variant: Column) -> Column:
    digest = F.sha2(F.concat_ws(":", sample.cast("string"), variant.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def items_json(items: Column) -> Column:
    """``{"items": [{"name": .., "count": ..}]}`` with spaces after separators."""
    parts = F.transform(items, lambda i: F.concat(
        F.lit('{"name": "'), i["name"], F.lit('", "count": '), i["count"].cast("string"), F.lit("}")))
    return F.concat(F.lit('{"items": ['), F.concat_ws(", ", parts), F.lit("]}"))


def actions_json(actions: Column) -> Column:
    parts = F.transform(actions, lambda a: F.concat(F.lit('"'), a, F.lit('"')))
    return F.concat(F.lit('{"ordered_actions": ['), F.concat_ws(", ", parts), F.lit("]}"))


def assistant_value(answer: Column, reasoning: Column | None = None) -> Column:
    """An answer, behind its reasoning block when there is one to write."""
    if reasoning is None:
        return answer
    return F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n\n"), answer)


def sharegpt(system: Column, user: Column, answer: Column, reasoning: Column | None = None) -> Column:
    """Two-turn sample struct."""
    turn = lambda role, value: F.struct(F.lit(role).alias("from"), value.alias("value"))
    return F.struct(system.alias("system"), F.array(
        turn("human", user), turn("gpt", assistant_value(answer, reasoning))).alias("conversations"))


def turn_value(conversations: Column, role: str, key: str = "from", value: str = "value", last: bool = False) -> Column:
    """Value of the first (or last) turn of a role."""
    return F.try_element_at(F.filter(conversations, lambda t: t[key] == role), F.lit(-1 if last else 1))[value]


def single_line(text: Column) -> Column:
    return F.regexp_replace(strip(or_empty(text)), r"\s+", " ")


def no_ordinals(text: Column) -> Column:
    """Counted wording replaced; the replacement keeps a leading capital."""
    for words, plain in ((ORDINALS_TO_A, "a"), (ORDINALS_TO_ANOTHER, "another")):
        capital = "|".join(w[0].upper() + "(?i:" + w[1:] + ")" for w in words if w[0].isalpha())
        small = "|".join(w[0] + "(?i:" + w[1:] + ")" for w in words)
        text = F.regexp_replace(text, rf"(?U)(?<!-)\b(?:{capital})\b(?!-)", plain.capitalize())
        text = F.regexp_replace(text, rf"(?U)(?<!-)\b(?:{small})\b(?!-)", plain)
    for pattern, replacement in ORDINAL_REPAIRS:
        text = F.regexp_replace(text, "(?iU)" + pattern, replacement)
    return text


def spelled(pattern: str) -> list[str]:
    """All lower-case phrases of a pattern of words, white space and optional parts."""
    part = re.search(r"\(\?:([^()]*)\)\?|(\w)\?", pattern)
    if part:
        before, after = pattern[:part.start()], pattern[part.end():]
        return [s for middle in (part[1] or part[2], "") for s in spelled(before + middle + after)]
    return [pattern.replace(r"\b", "").replace(r"\s+", " ")]


# The last rules join what others wrote; no other rule finds anything in a replacement, so those are one pass.
JOINING = [rule for rule in NEUTRAL_WORDS if rule[2] == "mobile map presence"]
SINGLE = [rule for rule in NEUTRAL_WORDS if rule not in JOINING]
NEUTRAL_OF = {phrase: replacement for pattern, replacement, _ in reversed(SINGLE) for phrase in spelled(pattern)}
# Two plain letters ahead tell most places apart before word ends and letters of either case are looked at.
AHEAD = "".join("[" + "".join(sorted(letters | {x.upper() for x in letters} | ({"\u017f"} if "s" in letters else set()))) + "]"
                for letters in ({phrase[i] for phrase in NEUTRAL_OF} for i in (0, 1)))
ANY_NEUTRAL = f"(?={AHEAD})" + r"(?iU)\b(?:" + "|".join(pattern.replace(r"\b", "") for pattern, _, _ in SINGLE) + r")\b"


def neutral_words(text: Column) -> Column:
    """Enemy wording replaced phrase by phrase, all phrases in one pass over the text.

    Where two rules fit, the one that begins first does, of those the earlier one:
    phrases that overlap are parts of one another, so that is what rule after rule gives.
    """
    bare = or_empty(text)
    neutral = F.create_map(*[F.lit(x) for pair in NEUTRAL_OF.items() for x in pair])
    # The long s is the one letter that matches s but is not lowered to it.
    key = lambda m: F.replace(F.lower(F.regexp_replace(m, r"(?U)\s+", " ")), F.lit("\u017f"), F.lit("s"))
    other = lambda m: F.coalesce(neutral[F.lower(m)], neutral[key(m)])
    parts, found = F.split(bare, ANY_NEUTRAL, -1), F.regexp_extract_all(bare, F.lit(ANY_NEUTRAL), F.lit(0))
    rest = F.zip_with(found, F.slice(parts, 2, 1 << 30), lambda m, after: F.concat(other(m), after))
    out = F.concat(parts[0], F.array_join(rest, ""))
    for pattern, replacement, sign in JOINING:
        out = F.when(F.contains(out, F.lit(sign)), F.regexp_replace(out, "(?iU)" + pattern, replacement)).otherwise(out)
    return single_line(out)


def closing_line(text: Column, number: Column) -> Column:
    """Final step on one line that ends in the closing sentence."""
    head = F.concat(F.lit("[Step "), number.cast("string"), F.lit("] "))
    lines = F.filter(F.transform(F.split(or_empty(text), "\n"), strip), lambda x: x != "")
    closings = F.array(*[F.lit(c) for c in CLOSINGS])
    ends = lambda x: F.exists(closings, lambda c: x.endswith(c))
    done = F.filter(lines, lambda x: ends(x) & ~F.array_contains(closings, x))
    closing = F.coalesce(F.try_element_at(F.filter(lines, lambda x: F.array_contains(closings, x)), F.lit(-1)), closings[0])
    body = F.concat_ws(" ", F.filter(lines, lambda x: ~F.array_contains(closings, x)))
    headed = F.when(body.startswith("[Step"), body).otherwise(F.concat(head, body))
    merged = F.when(F.contains(body, closing), body).otherwise(F.concat_ws(" ", headed, closing))
    return F.when(F.size(done) > 0, done[0]).when(body == "", F.concat(head, closing)).otherwise(merged)


def tech_requirements(chains: Column, action: Column) -> Column:
    """(entity, action) of the last step of each branch, from the chain that ends in the action, else the first."""
    ends_here = lambda c: F.regexp_extract(c, r"->\s*[^()\[\]]+\(([^()]*)\)\s*$", 1) == action
    chain = F.coalesce(F.try_element_at(F.filter(chains, ends_here), F.lit(1)), F.try_element_at(chains, F.lit(1)))
    body = F.when(F.contains(chain, F.lit(":")), strip(F.regexp_replace(chain, r"(?s)\A[^:]*:", ""))).otherwise(chain)
    branches = F.filter(F.regexp_extract_all(body, F.lit(r"\[([^\]]*)\]"), F.lit(1)), lambda b: strip(b) != "")
    last = lambda b: F.element_at(F.split(b, " -> "), -1)
    steps = F.transform(branches, lambda b: F.struct(
        strip(F.regexp_replace(last(b), r"\s*\([^()]*\)\s*$", "")).alias("entity"),
        found(last(b), r"\(([^()]*)\)\s*$").alias("action")))
    return F.filter(steps, lambda s: s["action"].isNull() | (s["action"] != action))


def model_rank(model: Column, fallback: Column) -> Column:
    """Rank name by substring; a 14b name contains 4b and so ranks as 4b."""
    key = F.lower(or_empty(model))
    return F.when(F.contains(key, F.lit("4b")), "4b").when(F.contains(key, F.lit("14b")), "14b").otherwise(fallback)


def safe_stem(text: Column) -> Column:
    safe = F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_"), r"\A_+|_+\z", "")
    return F.when(safe == "", "sample").otherwise(safe)


def sample_key(bot: Column, opponent: Column, map_name: Column, recorded: Column, stem: Column) -> Column:
    filled = lambda c, default: F.coalesce(F.nullif(c, F.lit("")), default)
    return safe_stem(F.concat_ws("_", bot, filled(opponent, F.lit("unknown")), filled(map_name, F.lit("unknown_map")),
                                 filled(recorded, stem)))


def bot_folder(path: Column) -> Column:
    """Folder above ``sequences``, else the first part, of a path below the data folder."""
    parts = F.split(path, "/")
    nested = (F.size(parts) >= 3) & (F.try_element_at(parts, F.lit(-2)) == "sequences")
    return F.when(nested, F.try_element_at(parts, F.lit(-3))).when(F.size(parts) >= 2, parts[0])


def difficulty_of(stated: Column, opponent: Column, stem: Column) -> Column:
    """Stated difficulty, else the last known token of the opponent id, else of the file stem."""
    known = F.array(*[F.lit(d) for d in DIFFICULTIES])
    last_known = lambda parts: F.try_element_at(F.filter(
        F.transform(parts, F.lower), lambda p: F.array_contains(known, p)), F.lit(-1))
    said = F.nullif(F.lower(strip(or_empty(stated))), F.lit(""))
    from_id = last_known(F.split(F.coalesce(F.nullif(opponent, F.lit("")), stem), r"\."))
    return F.coalesce(said, from_id, last_known(F.split(F.regexp_replace(stem, " ", "_"), "_")), F.lit("unknown"))


def race_of(stated: Column, opponent: Column) -> Column:
    said = F.lower(strip(or_empty(stated)))
    token = F.lower(F.try_element_at(F.split(or_empty(opponent), r"\."), F.lit(2)))
    return F.when(said.isin(*RACES), said).when(token.isin(*RACES), token).otherwise("unknown")


def counts_text(counts: Column, empty: str) -> Column:
    """``N name`` by falling count, then name."""
    entries = F.array_sort(F.map_entries(counts), lambda a, b: F.when(a["value"] != b["value"], b["value"] - a["value"])
                           .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0).cast("int"))
    text = F.concat_ws(", ", F.transform(entries, lambda e: F.concat(e["value"].cast("string"), F.lit(" "), e["key"])))
    return F.when(F.coalesce(F.size(counts), F.lit(0)) > 0, text).otherwise(empty)


def queues_text(counts: Column, empty: str = "none") -> Column:
    """As ``counts_text``; training names its count, research does not."""
    entries = F.array_sort(F.map_entries(counts), lambda a, b: F.when(a["value"] != b["value"], b["value"] - a["value"])
                           .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0).cast("int"))

    def line(e):
        n = e["value"].cast("string")
        return (F.when(F.rlike(e["key"], F.lit("^Researching .+")), e["key"])
                .when(F.rlike(e["key"], F.lit("^Training .+")), F.concat(F.lit("Training "), n, F.substring(e["key"], F.lit(9), F.length(e["key"]))))
                .otherwise(F.concat(n, F.lit(" "), e["key"])))

    text = F.concat_ws(", ", F.transform(entries, line))
    return F.when(F.coalesce(F.size(counts), F.lit(0)) > 0, text).otherwise(empty)
