"""Labelled steps: cut trajectories joined to their texts, cues and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.plans.steps import boundary_scores, soft_cues, split_steps, steps_to_actions

FAILED_MARK = "*(LLM call failed)*"


def failed_line(line: Column) -> Column:
    """Whether the step's text was not written."""
    return F.contains(line, F.lit(FAILED_MARK))


def label_steps(actions: DataFrame, games: DataFrame, texts: DataFrame, wanted: Column) -> DataFrame:
    """One row per step of the wanted games, with action range, cues and text.

    ``actions`` has traj_id, seq, ability; ``games`` traj_id and what the
    filter reads; ``texts`` traj_id, step_id, text (an input: nothing here
    writes text). ``relabel`` marks steps whose text is missing or failed.
    """
    kept = actions.join(games.filter(wanted).select("traj_id"), "traj_id", "left_semi")
    steps = split_steps(boundary_scores(kept))
    cues = soft_cues(steps_to_actions(steps, kept), ["traj_id", "step_id"])
    text = F.coalesce("text", F.lit(""))
    return steps.join(cues, ["traj_id", "step_id"]).join(texts, ["traj_id", "step_id"], "left").withColumn(
        "relabel", (text == "") | F.contains(text, F.lit(FAILED_MARK)))


def recover_labels(steps: DataFrame, lines: DataFrame) -> DataFrame:
    """Steps with the document line of their number; the status tells what was found.

    Documents number steps from 1. ``lines`` has traj_id, number, and line, or ``failed`` where that is known,
    or both.
    """
    marked = lines if "failed" in lines.columns else lines.withColumn("failed", failed_line(F.col("line")))
    found = marked.withColumn("step_id", (F.col("number") - 1).cast("bigint")).drop("number")
    docs = lines.select("traj_id", F.lit(True).alias("_doc")).distinct()
    status = (F.when(F.col("_doc").isNull(), "skipped_no_document").when(F.col("failed").isNull(), "skipped_missing_step")
              .when(F.col("failed"), "skipped_failed").otherwise("matched"))
    return steps.join(found, ["traj_id", "step_id"], "left").join(docs, "traj_id", "left").withColumn(
        "status", status).drop("_doc", "failed")
