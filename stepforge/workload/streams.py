"""Stateful streams over the event table, checked against the SQL of their batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.sources.files import run_folder
from stepforge.streaming import sinks
from stepforge.streaming import state as S
from stepforge.workload.registry import query
from stepforge.workload.timeline import CHANGES_SQL, COMMIT_SQL, SAMPLE_SQL, WAIT
from stepforge.workload.views import micros

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark, sf):
    rows = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 16).parquet(sf)
    return rows.select(F.col("user_id").alias("traj_id"), "event_id", micros("ts").alias("us"), "event_type", "value",
                       F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("ts").cast("timestamp").alias("ts"))


@query("sample_interval_stream", SAMPLE_SQL, using="traj")
def sample_interval_stream(spark, sf):
    rows = events(spark, sf).select("traj_id", "us", "event_id", "ts")
    return sinks.run_available(S.sample_interval(rows, 36_000), run_folder(spark, "sample"))


@query("pending_commit_stream", "WITH RECURSIVE " + COMMIT_SQL.format(wait=int(WAIT * 1e6)) + f""",
    n AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY us, event_id) AS rn FROM joined),
    walk AS (SELECT unit, rn, us, event_id, committed, true AS kept, coalesce(committed, us + {int(WAIT * 1e6)}) AS until
             FROM n WHERE rn = 1
             UNION ALL SELECT n.unit, n.rn, n.us, n.event_id, n.committed, n.us > w.until,
                 CASE WHEN n.us > w.until THEN coalesce(n.committed, n.us + {int(WAIT * 1e6)}) ELSE w.until END
             FROM walk w JOIN n ON n.unit = w.unit AND n.rn = w.rn + 1)
    SELECT unit, event_id, committed FROM walk WHERE kept AND committed IS NOT NULL""", using="traj")
def pending_commit_stream(spark, sf):
    kind = F.when(F.col("event_type") == "click", "issue").when(F.col("event_type") == "purchase", "seen")
    rows = events(spark, sf).select((F.col("traj_id") % 8).alias("unit"), "us", "event_id", kind.alias("kind"), "ts")
    return sinks.run_available(S.pending_commit(rows.filter(F.col("kind").isNotNull()), WAIT), run_folder(spark, "commit"))


@query("frame_diff_stream", f"SELECT * FROM ({CHANGES_SQL}) WHERE change <> 'last_seen'", using="traj")
def frame_diff_stream(spark, sf):
    rows = events(spark, sf).select(
        "traj_id", "us", "event_id", F.col("event_type").alias("kind"), F.col("value").alias("health"),
        (F.col("k") % 11 / 8.0).alias("progress"), (F.col("k") % 7).cast("double").alias("shield"),
        (F.col("k") % 13 == 0).alias("destroyed"), "ts")
    # Units are remembered for longer than the table lasts, so only the batch form knows which sighting was the last.
    found = sinks.run_available(S.frame_changes(rows, 86_400, 366 * 86_400), run_folder(spark, "changes"))
    return found.withColumn("amount", F.round("amount", 4))


@query("class_gate_stream", """
    SELECT event_type || k % 4 AS class, least(count(*), 7) AS admitted FROM traj GROUP BY 1""", using="traj")
def class_gate_stream(spark, sf):
    # Which rows of a class come first is up to the source; how many are admitted is not.
    klass = F.concat("event_type", (F.col("k") % 4).cast("string"))
    rows = events(spark, sf).select(klass.alias("class"), F.col("event_id").alias("index"))
    kept = sinks.run_available(S.class_gate(rows, 7), run_folder(spark, "gate"))
    return kept.groupBy("class").agg(F.count(F.lit(1)).alias("admitted"))


@query("append_log", """
    SELECT CASE WHEN value > 100 THEN 'audit' ELSE 'rejected' END AS log, count(*) AS rows FROM events GROUP BY 1
    UNION ALL SELECT 'detail', count(*) FROM events WHERE value <= 100 AND event_type = 'error'""")
def append_log(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "value")
    folder = run_folder(spark, "log")
    kept = F.col("value") > 100
    logs = {"audit": kept, "rejected": ~kept, "detail": ~kept & (F.col("event_type") == "error")}
    sinks.append_log(rows, folder, logs)
    counts = [sinks.read_log(spark, folder, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("log"), "rows")
              for name in logs]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("history_upsert_stream", """
    SELECT traj_id * 1000 + k AS guid, arg_max(event_id, (us, event_id)) AS event_id FROM traj GROUP BY 1""", using="traj")
def history_upsert_stream(spark, sf):
    rows = events(spark, sf).select((F.col("traj_id") * 1000 + F.col("k")).alias("guid"), "event_id", "us")
    folder = sinks.upsert(rows, run_folder(spark, "history"))
    return sinks.read_upserted(spark, folder, "guid", ["us", "event_id"]).select("guid", "event_id")
