"""Hard rules on generated answers and the decision per sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.functions import text as X

# Bounds of the rules.
LEAST_TASKS, MOST_TASKS = 5, 15
MOST_FOREIGN_NAMES, MOST_FOREIGN_TOKENS = 10, 20


def names_of(items: Column) -> Column:
    return F.array_distinct(F.transform(items, lambda i: i["name"]))


def joined(values: Column) -> Column:
    return F.concat_ws(", ", F.array_sort(values))


def rule_naming(gold: Column, generated: Column, cot: Column, canonical: Column) -> Column:
    """Reasons why generated items fail; empty means passed. Counts per type need not match."""
    total = F.aggregate(generated, F.lit(0).cast("bigint"), lambda t, i: t + i["count"])

    def reasons(v):
        missing, unknown = F.array_except(v["gold"], v["made"]), F.array_except(v["made"], canonical)
        foreign = X.name_mentions(canonical, v["cot"], F.concat(v["gold"], v["made"]))
        outside = (v["total"] < LEAST_TASKS) | (v["total"] > MOST_TASKS)
        return F.when(v["failed"], F.array(F.lit("parse_failed"))).otherwise(F.array_compact(F.array(
            F.when(F.size(missing) > 0, F.concat(F.lit("missing gold types: "), joined(missing))),
            F.when(F.size(unknown) > 0, F.concat(F.lit("non-canonical names: "), joined(unknown))),
            F.when(outside, F.concat(F.lit("total must be 5-15, got "), v["total"].cast("string"))),
            F.when(F.size(foreign) > MOST_FOREIGN_NAMES, F.lit("reasoning mentions many other names")))))

    return X.bind(F.struct(names_of(gold).alias("gold"), names_of(generated).alias("made"), total.alias("total"),
                           cot.alias("cot"), (gold.isNull() | generated.isNull()).alias("failed")), reasons)


def rule_ordering(prompt: Column, gold: Column, generated: Column, cot: Column) -> Column:
    """Reasons why a generated order fails: count, multiset, prompt, stated prerequisites, foreign tokens."""
    def reasons(v):
        source = F.when(F.size(v["listed"]) > 0, v["listed"]).otherwise(v["gold"])
        same = lambda a, b: F.array_sort(a) == F.array_sort(b)
        place = lambda a: F.array_position(v["made"], a)
        broken = F.filter(v["pairs"], lambda p: (place(p["action"]) > 0) & (place(p["depends"]) > 0)
                          & (place(p["action"]) < place(p["depends"])))
        fixed = F.array_compact(F.array(
            F.when(F.size(v["made"]) != F.size(v["gold"]), F.lit("action count differs")),
            F.when(~same(v["made"], v["gold"]), F.lit("action multiset differs from gold")),
            F.when(~same(source, v["gold"]), F.lit("input multiset differs from gold"))))
        order = F.transform(broken, lambda p: F.concat(p["depends"], F.lit(" must come before "), p["action"]))
        foreign = F.array_compact(F.array(F.when(
            F.size(X.token_mentions(v["cot"], source)) > MOST_FOREIGN_TOKENS, F.lit("reasoning mentions many other tokens"))))
        return F.when(v["gold"].isNull() | v["made"].isNull(), F.array(F.lit("parse_failed"))).otherwise(
            F.concat(fixed, order, foreign))

    return X.bind(F.struct(
        X.expand_counts(X.section(prompt, "Actions to order")).alias("listed"), X.prereq_pairs(prompt).alias("pairs"),
        gold.alias("gold"), generated.alias("made"), cot.alias("cot")), reasons)


def rule_executor(prompt: Column, gold: Column, generated: Column, cot: Column) -> Column:
    """Reasons why a chosen tag fails: no candidates, not a candidate, not the one reasoned about."""
    def reasons(v):
        return F.when(v["gold"].isNull() | v["made"].isNull(), F.array(F.lit("parse_failed"))).otherwise(
            F.array_compact(F.array(
                F.when(F.size(v["legal"]) == 0, F.lit("no candidate tags in prompt")),
                F.when(~F.array_contains(v["legal"], v["made"]), F.lit("tag is not a candidate")),
                F.when((F.size(v["named"]) > 0) & ~F.array_contains(v["named"], v["made"]),
                       F.lit("reasoning names other tags")))))

    return X.bind(F.struct(X.tags_in_text(prompt).alias("legal"), X.tags_in_text(cot).alias("named"), gold.alias("gold"),
                           generated.alias("made")), reasons)


def decide(samples: DataFrame, attempts: DataFrame, teacher: DataFrame, *, gated: Column | None = None,
           skip_teacher: bool = False, keep_drops: bool = False) -> DataFrame:
    """Stage, decision and final answer per sample.

    ``samples``: index, gold (null if unreadable). ``attempts``: index,
    attempt, answer, error, reasons. ``teacher``: index, decision, error. The
    first passing attempt wins, else the last rule failure is reported, else
    the generation error.
    """
    tried, failed = F.col("error").isNull(), F.size("reasons") > 0
    best = attempts.groupBy("index").agg(
        F.min_by("answer", F.when(tried & ~failed, F.col("attempt"))).alias("passing"),
        F.max_by(F.concat_ws("; ", "reasons"), F.when(tried & failed, F.col("attempt"))).alias("rule_error"),
        F.max_by("error", F.when(~tried, F.col("attempt"))).alias("call_error"))
    rows = samples.join(best, "index", "left").join(
        teacher.select("index", F.col("decision").alias("_said"), F.col("error").alias("_down")), "index", "left")
    allowed = F.col("_said").isin("drop", "use_gold_answer", "use_generated_answer")
    stage = F.when(F.col("gold").isNull(), "gold_parse")
    if gated is not None:
        stage = stage.when(gated, "class_target_met")
    stage = stage.when(F.col("passing").isNull() & F.col("rule_error").isNotNull(), "rule_check").when(
        F.col("passing").isNull(), "generation")
    if not skip_teacher:
        stage = stage.when(F.col("_down").isNotNull(), "teacher_call").when(
            ~F.coalesce(allowed, F.lit(False)), "teacher_parse")
        if not keep_drops:
            stage = stage.when(F.col("_said") == "drop", "teacher_drop")
    said = F.lit("skip_teacher_use_generated") if skip_teacher else F.when(
        F.col("_said") == "drop", "use_gold_answer").otherwise(F.col("_said"))
    rows = rows.withColumn("stage", stage)
    kept = F.col("stage").isNull()
    decision = F.when(kept, said).otherwise("drop")
    final = F.when(kept & (decision == "use_gold_answer"), F.col("gold")).when(kept, F.col("passing"))
    return rows.withColumn("decision", decision).withColumn("final", final).drop("_said", "_down")


