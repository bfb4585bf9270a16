"""Quality reports: one aggregation over a status column or a few conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def obs_qa(rows: DataFrame, file: str, *, text_missing: Column, structured_missing: Column,
           mismatch: Column, multi: Column) -> DataFrame:
    """Totals of a collection run, first per file and then over files."""
    per_file = rows.groupBy(file).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(text_missing).alias("t"),
        F.count_if(structured_missing).alias("s"), F.max(mismatch.cast("int")).alias("m"),
        F.count_if(multi).alias("c"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("actions"), F.sum("t").alias("missing_text"),
        F.sum("s").alias("missing_structured"), F.sum(F.col("m").cast("bigint")).alias("order_mismatch"),
        F.sum("c").alias("train_multi"))


def label_qa(expected: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Expected documents against existing and valid ones; passed when nothing is off."""
    want = expected.select(key, F.lit(True).alias("_wanted"))
    have = docs.select(key, F.lit(True).alias("_there"), "valid")
    wanted, there, valid = F.col("_wanted").isNotNull(), F.col("_there").isNotNull(), F.col("valid")
    totals = want.join(have, key, "full").agg(
        F.count_if(wanted).alias("expected"), F.count_if(wanted & there).alias("existing"),
        F.count_if(wanted & valid).alias("valid"), F.count_if(wanted & ~valid).alias("invalid"),
        F.count_if(wanted & ~there).alias("missing"))
    clean = (F.col("invalid") == 0) & (F.col("missing") == 0) & (F.col("expected") == F.col("valid"))
    return totals.withColumn("passed", clean & (F.col("existing") > 0))


def row_issues(rows: DataFrame, key: str, text: Column, mark: Column, no_obs: Column, limit: int | None = None) -> DataFrame:
    """Rows with an issue; the first ``limit`` of them in key order, if given."""
    issues = F.array_compact(F.array(
        F.when(F.trim(text) == "", "empty_step_text"), F.when(F.contains(text, mark), "llm_call_failed_mark"),
        F.when(no_obs, "missing_obs_text")))
    found = rows.select(key, issues.alias("issues")).filter(F.size("issues") > 0)
    if limit is not None:
        found = found.orderBy(key).limit(limit)
    return found.select(key, F.concat_ws(",", "issues").alias("issues"))


def fail_reasons(rows: DataFrame, reasons: str, limit: int | None = None) -> DataFrame:
    counted = rows.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counted if limit is None else counted.orderBy(F.desc("n"), "reason").limit(limit)


def injection_progress(rows: DataFrame, task: str) -> DataFrame:
    """Counters per task. Stages other than the two drops are in no drop counter."""
    stage = F.col("stage")
    return rows.groupBy(task).agg(
        F.count_if("generated").alias("generated"), F.count_if("rule_passed").alias("rule_pass"),
        F.count_if(stage.isNull()).alias("kept"), F.count_if(stage == "rule_check").alias("drop_rule_check"),
        F.count_if(stage == "teacher_drop").alias("drop_teacher"))


def golden_report(ranked: DataFrame, strategy: str) -> DataFrame:
    """Per strategy and overall: records, ties, reservations, fallbacks and the tie rate."""
    records, multi = F.count(F.lit(1)), F.count_if(F.col("golden") > 1)
    return ranked.rollup(strategy).agg(
        records.alias("records"), multi.alias("multi_golden"),
        F.count_if("reservation").alias("reservation_active"), F.count_if("fallback").alias("fallback_no_eligible"),
        F.round(multi / records, 4).alias("multi_golden_rate"))
