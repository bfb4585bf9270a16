"""Texts: reasoning tags, answers, rules and wording."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.plans import rules as R


def value(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("v")).first().v


# Wording before and after.
WORDING = [
    ("Build the first Barracks", "Build a Barracks"),
    ("First Barracks, second Factory", "A Barracks, another Factory"),
    ("a depot-first opening", "a depot-first opening"),
    ("Second base and your first Refinery", "Another base and your Refinery"),
    ("the 2nd one is the first one", "another one is an existing one"),
    ("add the next one", "add the another one"),
]


@pytest.mark.parametrize("before,after", WORDING)
def test_no_ordinals(spark, before, after):
    assert value(spark, X.no_ordinals, before) == after


def test_neutral_words(spark):
    assert value(spark, X.neutral_words, "Scout enemy threats\n and apply pressure, hold") == (
        "read the map state and add production tempo, stabilize")


def test_neutral_words_equal_rule_after_rule(spark):
    draw = random.Random(1)
    words = ["scout", "scouting", "Enemy", "threat", "threats", "to", "pressure", "the", "game", "apply", "cloaked", "harassers", "harasser", "HARASS",
             "harassment", "harrassment", "units", "harassing", "rush", "rushes", "opponent", "opponents", "move-out", "move out", "poke", "hold", "mobile",
             "map", "presence", "production", "tempo", "x", "(", ",", "scoutx", "\u017fcout", "thre\nats"]
    texts = ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\n", "", "-", "\u00a0"]) for _ in range(12)) for _ in range(3000)]

    def plain(text):
        for pattern, replacement, _ in X.NEUTRAL_WORDS:
            text = re.sub(pattern, replacement, text, flags=re.I)
        return " ".join(text.split())

    got = spark.createDataFrame([(t,) for t in texts], "t string").select(X.neutral_words(F.col("t")).alias("v")).collect()
    assert [" ".join(r.v.split()) for r in got] == [plain(t) for t in texts]


# Answers and what is read of them.
ITEMS = [
    ('"2.5"', None), ('"1e2"', None), ("true", 1), ("false", None), ("2.9", 2), ("1e2", 100), ('" 7 "', 7), ('"+3"', 3), ('"1_0"', 10), ("null", None),
    ("0.9", None), ("-4", None), ("[2]", None), ('"x"', None), ("12345678901", 12345678901),
]


@pytest.mark.parametrize("count,expected", ITEMS)
def test_counts_by_json_type(spark, count, expected):
    items = value(spark, X.parse_items, '{"items": [{"name": "A", "count": %s}]}' % count)
    assert (None if items is None else [tuple(i) for i in items]) == (None if expected is None else [("A", expected)])
    tags = value(spark, X.parse_tags, f"[{count}]")
    assert tags == {"false": 0, "0.9": 0, "-4": -4}.get(count, expected)


def test_items_that_are_none(spark):
    for text in ('{"items": [{"name": "A", "count": 1}]} {"x": 1}', '{"items": [{"name": "A", "count": 1}]} tail', '{"items": [1]}', '{"items": {}}', "[1]", "", "{}",
                 '{"items": [{"name": "", "count": 1}]}', '{"items": [{"count": 1}]}', '{"items": [{"name": 0, "count": 1}]}', '{"items": [{"name": [], "count": 1}]}'):
        assert value(spark, X.parse_items, text) is None, text
    assert value(spark, X.parse_items, '{"items": []}') == []
    got = value(spark, X.parse_items, '{"items": [{"name": 5, "count": 1}, {"name": true, "count": 2}]}')
    assert [tuple(i) for i in got] == [("5", 1), ("True", 2)]


def test_split_reasoning_modes(spark):
    def parts(text, **fields):
        return lambda t: X.split_reasoning(t, {k: F.lit(v) for k, v in fields.items()})

    got = value(spark, parts(None, reasoning=" why "), "<think>a</think> b")
    assert (got.reasoning, got.final, got.source) == ("why", "<think>a</think> b", "message.reasoning")
    got = value(spark, parts(None), "x <THINK foo='1'>a\nb</Think> c")
    assert (got.reasoning, got.final, got.source) == ("a\nb", "x  c", "content.think")
    got = value(spark, parts(None), "out <think>rest of it")
    assert (got.reasoning, got.final, got.source) == ("rest of it", "out", "content.think.dangling")
    got = value(spark, lambda t: X.split_reasoning(t, {}, "none"), "<think>a</think>")
    assert (got.reasoning, got.source) == ("", "none")


def test_json_candidate(spark):
    assert value(spark, X.json_candidate, "```json\n{\"a\": 1}\n```") == '{"a": 1}'
    assert value(spark, X.json_candidate, "{ no\nAnswer: [1, 2] tail") == "[1, 2]"
    assert value(spark, lambda t: X.json_candidate(t, True), "Answer: {\"a\": [3]}") == "[3]"
    assert value(spark, X.json_candidate, "  nothing ") == "nothing"


def test_parse_items(spark):
    assert value(spark, X.parse_items, '{"items": [{"name": "A", "count": 0}]}') is None
    assert value(spark, X.parse_items, "[]") is None
    assert [tuple(i) for i in value(spark, X.parse_items, '{"items": [{"name": "A", "count": 2}]}')] == [("A", 2)]


def test_tech_requirements(spark):
    chains = F.array(F.lit("Z: [Q] -> Z (OTHER)"), F.lit("T: [A -> B (ACT)] [C] -> T (ME)"))
    got = value(spark, lambda t: X.tech_requirements(chains, t), "ME")
    assert [tuple(r) for r in got] == [("B", "ACT"), ("C", None)]
    first = value(spark, lambda t: X.tech_requirements(chains, t), "NOT_LISTED")
    assert [tuple(r) for r in first] == [("Q", None)]


def test_closing_line(spark):
    closing = X.CLOSINGS[0]
    line = lambda t: X.closing_line(t, F.lit(4))
    assert value(spark, line, "") == f"[Step 4] {closing}"
    assert value(spark, line, f"[Step 4] go\n\n{closing}") == f"[Step 4] go {closing}"
    assert value(spark, line, "go\nnow") == f"[Step 4] go now {closing}"
    assert value(spark, line, f"[Step 4] done {closing}\nmore") == f"[Step 4] done {closing}"


def test_rule_ordering_reports_broken_prerequisites(spark):
    prompt = "[Actions to order]\nA1 x 2\nB1\n[Hints]\n  - A1 requires B1 first (via Q)"
    gold, made = F.array(*[F.lit(x) for x in ("B1", "A1", "A1")]), F.array(*[F.lit(x) for x in ("A1", "B1", "A1")])
    got = value(spark, lambda t: R.rule_ordering(t, gold, made, F.lit("")), prompt)
    assert got == ["B1 must come before A1"]


def test_model_rank_keeps_the_order_of_tests(spark):
    assert value(spark, lambda t: X.model_rank(t, F.lit("32b")), "Qwen-14B") == "4b"


def test_counts_text(spark):
    counts = F.create_map(F.lit("b"), F.lit(2), F.lit("a"), F.lit(2), F.lit("c"), F.lit(5))
    assert value(spark, lambda t: X.counts_text(counts, "none"), "") == "5 c, 2 a, 2 b"
    queues = F.create_map(F.lit("Training MARINE"), F.lit(3), F.lit("Researching STIM"), F.lit(1))
    assert value(spark, lambda t: X.queues_text(queues), "") == "Training 3 MARINE, Researching STIM"
