"""Labelled steps and labels recovered from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.plans import labels as P
from stepforge.plans.steps import split_steps
from stepforge.plans.steps import boundary_scores
from stepforge.session import cut_lineage
from stepforge.workload.registry import query
from stepforge.workload.steps import CUE_SQL, SPLIT_SQL, cue_names, numbered_once
from stepforge.workload.views import table

GAMES_SQL = "won AS (SELECT traj_id FROM traj GROUP BY traj_id HAVING count(*) FILTER (event_type = 'purchase') >= 12)"
WON_SPLIT = SPLIT_SQL.replace("FROM traj)", "FROM traj WHERE traj_id IN (SELECT traj_id FROM won))")
TEXTS_SQL = "texts AS (SELECT doc_id % 100 AS traj_id, doc_id // 100 AS step_id, lang = 'de' AS failed, n_chars FROM documents)"


@query("label_steps", f"""WITH RECURSIVE {GAMES_SQL}, {WON_SPLIT}, {TEXTS_SQL},
    covered AS (SELECT t.traj_id, step_id, ability FROM steps s JOIN traj t ON t.traj_id = s.traj_id AND t.seq BETWEEN first AND last),
    cues AS ({CUE_SQL.format(keys="traj_id, step_id", rows="covered")})
    SELECT s.traj_id, s.step_id, first, last, CASE WHEN cues = '' THEN 'macro_pacing' ELSE cues END AS cues, n_chars,
        coalesce(failed, true) AS relabel FROM steps s JOIN cues c ON c.traj_id = s.traj_id AND c.step_id = s.step_id
    LEFT JOIN texts t ON t.traj_id = s.traj_id AND t.step_id = s.step_id""", using="traj")
def label_steps(spark, sf):
    rows = numbered_once(spark, sf)
    games = rows.groupBy("traj_id").agg(F.count_if(F.col("event_type") == "purchase").alias("bought"))
    doc = F.col("doc_id")
    text = F.when(F.col("lang") == "de", F.lit(P.FAILED_MARK)).otherwise(F.col("text"))
    texts = table(spark, sf, "documents").select(
        (doc % 100).alias("traj_id"), F.floor(doc / 100).alias("step_id"), text.alias("text"), "n_chars")
    out = P.label_steps(rows, games, texts, F.col("bought") >= 12)
    return out.select("traj_id", "step_id", F.col("start").alias("first"), F.col("end").alias("last"),
                      cue_names(F.col("cues")).alias("cues"), "n_chars", "relabel")


@query("recover_labels", f"""WITH RECURSIVE {SPLIT_SQL},
    l AS (SELECT doc_id % 100 AS traj_id, 1 + doc_id // 100 AS number, lang = 'de' AS failed FROM documents)
    SELECT s.traj_id, s.step_id, CASE WHEN s.traj_id NOT IN (SELECT traj_id FROM l) THEN 'skipped_no_document'
        WHEN l.traj_id IS NULL THEN 'skipped_missing_step' WHEN failed THEN 'skipped_failed' ELSE 'matched' END AS status
    FROM steps s LEFT JOIN l ON l.traj_id = s.traj_id AND l.number = s.step_id + 1""", using="traj")
def recover_labels(spark, sf):
    from stepforge.sources.files import parse_step_lines

    doc = F.col("doc_id")
    number = F.floor(doc / 100) + 1
    body = F.when(F.col("lang") == "de", F.lit(P.FAILED_MARK)).otherwise(F.regexp_replace("text", r"\s+", " "))
    lines = table(spark, sf, "documents").select(
        (doc % 100).alias("traj_id"), doc.alias("at"),
        F.concat(F.lit("[Step "), number.cast("string"), F.lit("] "), body).alias("value"))
    steps = split_steps(boundary_scores(numbered_once(spark, sf)))
    # The status needs no texts: what a line says of itself is written once, and read for the lines and for their documents.
    marked = parse_step_lines(lines, ["traj_id"], {"failed": P.failed_line(F.col("line"))}).drop("line")
    return P.recover_labels(steps, cut_lineage(marked)).select("traj_id", "step_id", "status")
