"""Golden cases of parsing and ranking candidate executors."""

import pytest
from pyspark.sql import functions as F

from stepforge.functions import text as X
from stepforge.plans import ranking as R
from stepforge.workload import all_queries

# Ability, pending conflicts, candidate lines, golden tags.
CASES = [
    ("BARRACKSTRAIN_MARINE", ["BARRACKSTRAIN_MARINE"],
     ["tag=985 BARRACKS [idle, has TechLab]", "tag=657 BARRACKS [idle, no add-on]"], [985]),
    ("BARRACKSTRAIN_MARINE", ["BUILD_TECHLAB_BARRACKS"],
     ["tag=985 BARRACKS [idle, has TechLab]", "tag=657 BARRACKS [idle, no add-on]"], [985]),
    ("BARRACKSTRAIN_MARINE", ["BUILD_REACTOR_BARRACKS"],
     ["tag=234 BARRACKS [idle, has Reactor]", "tag=251 BARRACKS [idle, has TechLab]", "tag=137 BARRACKS [idle, no add-on]"],
     [234]),
    ("COMMANDCENTERTRAIN_SCV", ["COMMANDCENTERTRAIN_SCV"],
     ["tag=233 ORBITALCOMMAND [busy: Train SCV (97%)]", "tag=857 ORBITALCOMMAND [busy: Train SCV (23%)]"], [233]),
    ("COMMANDCENTERTRAIN_SCV", ["COMMANDCENTERTRAIN_SCV"],
     ["tag=233 ORBITALCOMMAND [idle]", "tag=289 COMMANDCENTER [idle]"], [233]),
    ("COMMANDCENTERTRAIN_SCV", ["UPGRADETOORBITAL_ORBITALCOMMAND"],
     ["tag=233 ORBITALCOMMAND [idle]", "tag=289 COMMANDCENTER [idle]"], [233]),
    ("BARRACKSTRAIN_MARINE", [],
     ["tag=100 BARRACKS [idle, has Reactor]", "tag=200 BARRACKS [idle, has Reactor]"], [100, 200]),
    # All candidates are kept back: ranking falls back to all of them.
    ("BARRACKSTRAIN_MARINE", ["BUILD_TECHLAB_BARRACKS"],
     ["tag=1 BARRACKS [idle, no add-on]", "tag=2 BARRACKS [busy: X (40%), no add-on]"], [1]),
]


def prompt(spark, ability, conflicts, lines):
    listed = "\n".join(f"  - {c}" for c in conflicts) if conflicts else "  (none)"
    system = (f"Selector.\n\n[Ability to execute] {ability}\n[Possible conflicts in pending actions]\n{listed}\n\n"
              "Output ONLY a JSON list")
    user = "[Candidate Executors]\n" + "\n".join(f"  - {line}" for line in lines)
    return spark.createDataFrame([(1, system, user)], "prompt int, system string, user string")


@pytest.mark.parametrize("ability,conflicts,lines,golden", CASES)
def test_golden(spark, ability, conflicts, lines, golden):
    rows = prompt(spark, ability, conflicts, lines)
    parsed = rows.select("prompt", F.inline(X.parse_candidates(F.col("user")))).withColumnRenamed("idle", "is_idle")
    asked = rows.select("prompt", F.regexp_extract("system", X.ABILITY, 1).alias("ability"),
                        X.parse_conflicts(F.col("system")).alias("conflicts"))
    ranked = R.golden_rank(parsed, asked)
    assert sorted(r.tag for r in ranked.filter("golden").collect()) == golden
    fallback = ranked.agg(F.max("fallback")).first()[0]
    assert fallback == (golden == [1])


def test_parse(spark):
    rows = prompt(spark, *CASES[0][:3])
    found = rows.select(X.parse_candidates(F.col("user")).alias("c")).first().c
    assert [(c.tag, c.unit, c.idle, c.addon) for c in found] == [
        (985, "BARRACKS", True, "techlab"), (657, "BARRACKS", True, "none")]


def test_conflict_heading_is_a_parameter(spark):
    row = spark.createDataFrame([("[Other heading]\n  - A\n  - (none)\n\nOutput",)], "t string")
    assert row.select(X.parse_conflicts(F.col("t"), "Other heading")).first()[0] == ["A"]
    assert row.select(X.parse_conflicts(F.col("t"))).first()[0] == []


@pytest.mark.parametrize("ability,conflicts,lines,golden", CASES)
def test_golden_tags_of_a_row(spark, ability, conflicts, lines, golden):
    rows = prompt(spark, ability, conflicts, lines)
    tags = R.golden_tags(X.parse_candidates(F.col("user")), F.regexp_extract("system", X.ABILITY, 1), X.parse_conflicts(F.col("system")))
    found = rows.select(tags.alias("g")).first().g
    assert found.golden_tags == golden and found.fallback == (golden == [1])
    assert found.reservation == any(c.startswith(("BUILD_", "UPGRADETO")) for c in conflicts)
    assert rows.withColumn("user", F.lit("none")).select(tags.alias("g")).first().g is None


@pytest.mark.parametrize("name", ["golden_annotate", "parse_candidates", "rule_executor", "candidate_text", "executor_lines"])
def test_lists_of_candidates_take_one_exchange(spark, name):
    plan = all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "Window" not in plan
