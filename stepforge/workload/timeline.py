"""Events as frames, sightings and orders over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.operators import state as T
from stepforge.operators.keyed import first_per_key, top_per_key
from stepforge.operators.ordered import blocked_window
from stepforge.plans import detect as D
from stepforge.workload.registry import query
from stepforge.workload.views import HOUR, hour_of, traj_raw

ORDER = ["us", "event_id"]


@query("asof_last_seen", """
    SELECT event_id, round((us - max(CASE WHEN event_type = 'view' THEN us END)
        OVER (PARTITION BY traj_id ORDER BY us, event_id)) / 1e6, 3) AS seconds_since FROM traj""", using="traj")
def asof_last_seen(spark, sf):
    rows = T.last_seen(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), F.col("event_type") == "view")
    return rows.select("event_id", F.round("seconds_since", 3).alias("seconds_since"))


COMMIT_SQL = """issued AS (SELECT event_id, traj_id % 8 AS unit, us FROM traj WHERE event_type = 'click'),
    seen AS (SELECT traj_id % 8 AS unit, us AS at FROM traj WHERE event_type = 'purchase'),
    joined AS (SELECT i.unit, i.us, i.event_id, min(s.at) AS committed FROM issued i LEFT JOIN seen s
               ON s.unit = i.unit AND s.at BETWEEN i.us AND i.us + {wait} GROUP BY ALL)"""
WAIT = 3600.0


def issued_and_seen(spark, sf):
    # Users are spread over few units so that orders of one unit come close together.
    rows = traj_raw(spark, sf).withColumn("unit", F.col("traj_id") % 8)
    issued = rows.filter(F.col("event_type") == "click").select("unit", "us", "event_id")
    return issued, rows.filter(F.col("event_type") == "purchase").select("unit", "us")


@query("commit_join", "WITH " + COMMIT_SQL.format(wait=int(WAIT * 1e6)) + """
    SELECT event_id, committed, CASE WHEN committed IS NULL THEN 'expired' ELSE 'committed' END AS status FROM joined""",
       using="traj")
def commit_join(spark, sf):
    issued, seen = issued_and_seen(spark, sf)
    rows = T.commits(issued, seen, ["unit"], WAIT)
    return rows.select("event_id", "committed", F.when(
        F.col("committed").isNull(), "expired").otherwise("committed").alias("status"))


@query("pending_commit", "WITH RECURSIVE " + COMMIT_SQL.format(wait=int(WAIT * 1e6)) + f""",
    n AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY us, event_id) AS rn FROM joined),
    walk AS (SELECT unit, rn, us, event_id, committed, true AS kept, coalesce(committed, us + {int(WAIT * 1e6)}) AS until
             FROM n WHERE rn = 1
             UNION ALL SELECT n.unit, n.rn, n.us, n.event_id, n.committed, n.us > w.until,
                 CASE WHEN n.us > w.until THEN coalesce(n.committed, n.us + {int(WAIT * 1e6)}) ELSE w.until END
             FROM walk w JOIN n ON n.unit = w.unit AND n.rn = w.rn + 1)
    SELECT event_id, unit, row_number() OVER (PARTITION BY unit ORDER BY committed, event_id) - 1 AS seq
    FROM walk WHERE kept AND committed IS NOT NULL""", using="traj")
def pending_commit(spark, sf):
    issued, seen = issued_and_seen(spark, sf)
    rows = T.commits(issued, seen, ["unit"], WAIT)
    kept = T.accepted_issues(rows, ["unit"], ORDER, hour_of(), WAIT)
    done = kept.filter(F.col("committed").isNotNull())
    numbered = blocked_window(done, ["unit"], ["committed", "event_id"], hour_of("committed"), number="seq")
    return numbered.select("event_id", "unit", "seq")


SAMPLE_SQL = """WITH RECURSIVE n AS (SELECT traj_id, us, event_id, seq FROM traj),
    walk AS (SELECT traj_id, seq, us, event_id, true AS kept, us AS last FROM n WHERE seq = 0
        UNION ALL SELECT n.traj_id, n.seq, n.us, n.event_id, n.us - w.last >= 36000000000,
            CASE WHEN n.us - w.last >= 36000000000 THEN n.us ELSE w.last END
        FROM walk w JOIN n ON n.traj_id = w.traj_id AND n.seq = w.seq + 1)
    SELECT traj_id, us, event_id FROM walk WHERE kept"""


@query("sample_interval", SAMPLE_SQL, using="traj")
def sample_interval(spark, sf):
    rows = traj_raw(spark, sf).select("traj_id", "us", "event_id")
    return T.sample_interval(rows, ["traj_id"], ORDER, hour_of(), 36_000)


NOW = 1706486400_000_000  # 2024-01-29 00:00 UTC


@query("ghost_units", f"""
    WITH s AS (SELECT traj_id, us, CASE event_type WHEN 'error' THEN 'destroyed' WHEN 'signup' THEN 'empty' ELSE 'seen' END
                   AS kind, k % 2 = 0 AS flying, k % 5 = 0 AS burrowed, k % 3 = 0 AS detected, k // 4 AS tag FROM traj
               WHERE us <= {NOW}),
    l AS (SELECT traj_id, tag, max(us) FILTER (kind = 'seen') AS us, arg_max(flying, us) FILTER (kind = 'seen') AS flying,
          arg_max(burrowed, us) FILTER (kind = 'seen') AS burrowed, bool_or(kind = 'destroyed') AS dead,
          list(us) FILTER (kind = 'empty') AS empties, list(us) FILTER (kind = 'empty' AND detected) AS searches
          FROM s GROUP BY ALL)
    SELECT traj_id, tag, us, round(({NOW} - us) / 1e6, 3) AS age FROM l
    WHERE us IS NOT NULL AND NOT dead AND ({NOW} - us) / 1e6 BETWEEN 0.000001 AND CASE WHEN flying THEN 400000 ELSE 900000 END
      AND len(list_filter(coalesce(CASE WHEN burrowed THEN searches ELSE empties END, []), lambda e: e > us)) = 0""", using="traj")
def ghost_units(spark, sf):
    kind = F.when(F.col("event_type") == "error", "destroyed").when(
        F.col("event_type") == "signup", "empty").otherwise("seen")
    k = F.col("k")
    rows = traj_raw(spark, sf).select(
        "traj_id", F.floor(k / 4).alias("tag"), "us", kind.alias("kind"), (k % 2 == 0).alias("flying"),
        (k % 5 == 0).alias("burrowed"), (k % 3 == 0).alias("detected"))
    found = T.ghosts(rows, ["traj_id", "tag"], NOW, 400_000, 900_000)
    return found.select("traj_id", "tag", "us", F.round("age", 3).alias("age"))


@query("expiring_state", """
    WITH w AS (SELECT event_id, us, max(CASE WHEN event_type = 'purchase' THEN us END) OVER p AS wrote,
        last_value(CASE WHEN event_type = 'purchase' THEN k END IGNORE NULLS) OVER p AS v
        FROM traj WINDOW p AS (PARTITION BY traj_id ORDER BY us, event_id))
    SELECT event_id, CASE WHEN us - wrote < 36000000000 THEN v END AS visible FROM w""", using="traj")
def expiring_state(spark, sf):
    written = F.when(F.col("event_type") == "purchase", F.col("k"))
    rows = T.expiring(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), written, 36_000)
    return rows.select("event_id", "visible")


@query("heat_decay", """
    WITH RECURSIVE r AS (SELECT k // 5 AS cell, row_number() OVER (PARTITION BY k // 5 ORDER BY us, event_id) AS rn,
            0.1 + (traj_id % 10) / 10.0e0 AS dt, event_type = 'view' AS visible, value / 100 AS power FROM traj),
    h AS (SELECT cell, 0 AS rn, 0.0e0 AS heat FROM r GROUP BY cell
          UNION ALL SELECT r.cell, r.rn, greatest(0, CASE WHEN visible THEN (heat - dt * 0.02e0) * (1 - dt * 0.5e0)
              ELSE (heat - dt * 0.01e0) * (1 - dt * 0.25e0) END) + power * dt
          FROM h JOIN r ON r.cell = h.cell AND r.rn = h.rn + 1)
    SELECT cell, round(arg_max(heat, rn), 4) AS heat FROM h GROUP BY cell""", using="traj")
def heat_decay(spark, sf):
    rows = traj_raw(spark, sf).withColumn("cell", F.floor(F.col("k") / 5))
    dt = F.lit(0.1) + (F.col("traj_id") % 10) / 10.0
    visible, gain = F.col("event_type") == "view", F.col("value") / 100 * dt
    lost = F.when(visible, 0.02).otherwise(0.01)
    keep = 1 - dt * F.when(visible, 0.5).otherwise(0.25)
    heat = T.clamp_fold(rows, ["cell"], ORDER, HOUR, a=keep, b=gain - dt * lost * keep, low=gain,
                        high=F.lit(float("inf")))
    return heat.select("cell", F.round("value", 4).alias("heat"))


@query("stealth_heat", """
    WITH RECURSIVE r AS (SELECT k // 5 AS cell, row_number() OVER (PARTITION BY k // 5 ORDER BY us, event_id) AS rn,
            0.1 + (traj_id % 10) / 10.0e0 AS dt, event_type = 'error' AS hidden FROM traj),
    h AS (SELECT cell, 0 AS rn, 0.0e0 AS heat FROM r GROUP BY cell
          UNION ALL SELECT r.cell, r.rn, least(2, greatest(0, (heat + CASE WHEN hidden THEN dt ELSE 0 END - dt)
              * (1 - dt * 0.5e0))) FROM h JOIN r ON r.cell = h.cell AND r.rn = h.rn + 1)
    SELECT cell, round(arg_max(heat, rn), 4) AS heat FROM h GROUP BY cell""", using="traj")
def stealth_heat(spark, sf):
    rows = traj_raw(spark, sf).withColumn("cell", F.floor(F.col("k") / 5))
    dt = F.lit(0.1) + (F.col("traj_id") % 10) / 10.0
    added = F.when(F.col("event_type") == "error", dt).otherwise(0.0)
    keep = 1 - dt * 0.5
    heat = T.clamp_fold(rows, ["cell"], ORDER, HOUR, a=keep, b=(added - dt) * keep, low=F.lit(0.0), high=F.lit(2.0))
    return heat.select("cell", F.round("value", 4).alias("heat"))


FRAMES = {
    "nexuses": "k % 3", "expanded": "k % 17 = 0", "near_robo": "k % 19 = 0", "near_gates": "k % 4", "core": "k % 6 = 0",
    "only_main": "k % 5 > 0", "gates": "k % 5", "robos": "k % 4", "gas": "k % 3", "barracks": "k % 4",
    "near_barracks": "k % 3", "techlabs": "k % 3", "factories": "k % 2", "hatcheries": "k % 4",
    "enemy_workers": "k % 23", "roaches": "k % 7", "zerglings": "k % 9", "workers_close": "k % 11",
}
STARTS = {"warren_start": 140, "pool_start": 45, "second_hatchery": 60, "extractor_start": 75}


def frames(spark, sf):
    rows = traj_raw(spark, sf).select("traj_id", "us", "event_id", "k", (F.col("k") * 2.5).alias("time"))
    rows = rows.withColumn("game", F.concat_ws("-", "traj_id", F.floor(F.col("us") / 86_400_000_000)))
    rows = rows.withColumns({n: F.expr(e) for n, e in FRAMES.items()})
    starts = {n: F.when(F.col("k") % 4 == 0, F.lit(s) - F.col("k") % 30) for n, s in STARTS.items()}
    races = F.array(F.lit("Terran"), F.lit("Zerg"), F.lit("Protoss"))
    return rows.withColumns(starts).withColumn(
        "race", F.element_at(races, (F.col("traj_id") % 3 + 1).cast("int")))


FRAMES_SQL = ("frames AS (SELECT traj_id, us, event_id, k, k * 2.5 AS time, "
              "traj_id || '-' || us // 86400000000 AS game, "
              + ", ".join(f"{e} AS {n}" for n, e in FRAMES.items()) + ", "
              + ", ".join(f"CASE WHEN k % 4 = 0 THEN {s} - k % 30 END AS {n}" for n, s in STARTS.items())
              + ", (['Terran', 'Zerg', 'Protoss'])[traj_id % 3 + 1] AS race FROM traj)")


@query("rush_detect", f"WITH {FRAMES_SQL}" + """, v AS (SELECT game, us, event_id, coalesce(CASE race
        WHEN 'Protoss' THEN CASE WHEN nexuses > 1 OR expanded THEN 'Macro' WHEN near_robo THEN 'ProxyRobo'
            WHEN time < 125 THEN CASE WHEN gates > 2 AND gas = 1 THEN 'AdeptRush' WHEN gates > 2 AND gas = 0 THEN 'Zealots'
                WHEN gates <= 2 AND gates + robos > 2 THEN 'RoboRush'
                WHEN time > 110 AND near_gates = 0 AND NOT core AND only_main THEN 'ProxyZealots' END END
        WHEN 'Terran' THEN CASE WHEN expanded THEN 'Macro' WHEN time < 120 THEN CASE
            WHEN techlabs = barracks AND barracks >= 1 AND factories = 0 THEN 'Marauders'
            WHEN time > 110 AND near_barracks = 0 AND factories = 0 AND only_main THEN 'ProxyRax'
            WHEN barracks + factories > 2 THEN 'OneBaseRax' END END
        ELSE CASE WHEN hatcheries > 2 OR enemy_workers > 20 THEN 'Macro'
            WHEN warren_start < 130 OR (time < 160 AND roaches > 0) THEN 'RoachRush' WHEN pool_start < 26 THEN 'Pool12'
            WHEN pool_start < 40 THEN 'PoolFirst'
            WHEN time > 120 AND time < 130 AND hatcheries = 1 AND pool_start < 70 THEN 'OneHatcheryAllIn'
            WHEN zerglings > 0 AND time < 92 THEN 'Pool12'
            WHEN second_hatchery < 50 AND extractor_start < 70 AND pool_start < 70 AND enemy_workers < 17
            THEN 'HatchPool15_14' END END, CASE WHEN workers_close > 9 THEN 'WorkerRush' END) AS v
        FROM frames WHERE time <= 180)
    SELECT game, CASE WHEN bool_or(v = 'WorkerRush') THEN 'WorkerRush'
        ELSE coalesce(arg_max(v, (us, event_id)) FILTER (v IS NOT NULL), 'Start') END AS rush FROM v GROUP BY game""",
       using="traj")
def rush_detect(spark, sf):
    race = F.col("race")
    rule = F.when(race == "Protoss", D.protoss_rush()).when(race == "Terran", D.terran_rush()).otherwise(D.zerg_rush())
    return D.rush_detect(frames(spark, sf), ["game"], rule, ORDER)


MARKERS = {"Terran": ["BATTLECRUISER", "BANSHEE"], "Zerg": ["MUTALISK", "LURKERMP"], "Protoss": ["TEMPEST", "CARRIER"]}


@query("macro_detect", f"WITH {FRAMES_SQL}" + """, f AS (SELECT *, k * 5 AS t FROM frames),
    v AS (SELECT game, us, event_id, CASE WHEN t < 420 AND k % 20 = 7 THEN 'First' || race
              WHEN t < 420 AND k % 20 = 9 THEN 'Second' || race
              WHEN race = 'Terran' AND t > 420 AND t < 480 AND k > 16 AND k % 15 > 0 THEN 'Mmm' END AS v FROM f)
    SELECT game, CASE coalesce(arg_min(v, (us, event_id)) FILTER (v IS NOT NULL), 'StandardMacro')
        WHEN 'FirstTerran' THEN 'BattleCruisers' WHEN 'SecondTerran' THEN 'Banshees' WHEN 'FirstZerg' THEN 'Mutalisks'
        WHEN 'SecondZerg' THEN 'Lurkers' WHEN 'FirstProtoss' THEN 'Tempests' WHEN 'SecondProtoss' THEN 'Carriers'
        WHEN 'Mmm' THEN 'Mmm' ELSE 'StandardMacro' END AS macro FROM v GROUP BY game""", using="traj")
def macro_detect(spark, sf):
    k, race = F.col("k"), F.col("race")

    def marker(position):
        pairs = [F.lit(x) for r, names in MARKERS.items() for x in (r, names[position])]
        return F.create_map(*pairs)[race]

    rows = frames(spark, sf).withColumn("time", k * 5).withColumn(
        "marker", F.when(k % 20 == 7, marker(0)).when(k % 20 == 9, marker(1)))
    rows = rows.withColumn("marines", k + 1).withColumn("marauders", k).withColumn("medivacs", k % 15)
    return D.macro_detect(rows, ["game"], ORDER)


@query("cloak_trigger", """
    SELECT event_id, max(CASE WHEN ability IN ('STARPORTTRAIN_BANSHEE', 'ATTACK') THEN 1 ELSE 0 END)
        OVER (PARTITION BY traj_id ORDER BY us, event_id) = 1 AS cloak FROM traj""", using="traj")
def cloak_trigger(spark, sf):
    seen = F.col("ability").isin("STARPORTTRAIN_BANSHEE", "ATTACK").cast("int")
    rows = blocked_window(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), maxima={"_seen": seen})
    return rows.select("event_id", (F.col("_seen") == 1).alias("cloak"))


CHANGES_SQL = """
    WITH s AS (SELECT traj_id, event_id, us, event_type AS kind, value AS health, (k % 11) / 8.0 AS progress,
        (k % 7) / 1.0e0 AS shield, lag((k % 7) / 1.0e0) OVER w AS psh, k % 13 = 0 AS destroyed, lag(us) OVER w AS pus, lag(event_type) OVER w AS pk, lag(value) OVER w AS ph, lag((k % 11) / 8.0) OVER w AS pp,
        lead(us) OVER w AS nus FROM traj WINDOW w AS (PARTITION BY traj_id ORDER BY us, event_id))
    SELECT traj_id, event_id, 'created' AS change, 0.0 AS amount FROM s WHERE pus IS NULL
    UNION ALL SELECT traj_id, event_id, 'entered_view', 0.0 FROM s WHERE us - pus > 86400000000
    UNION ALL SELECT traj_id, event_id, 'left_view', 0.0 FROM s WHERE nus - us > 86400000000
    UNION ALL SELECT traj_id, event_id, 'damaged', round(ph - health + psh - shield, 4) FROM s WHERE health < ph OR shield < psh
    UNION ALL SELECT traj_id, event_id, 'type_changed', 0.0 FROM s WHERE kind <> pk
    UNION ALL SELECT traj_id, event_id, 'construction_started', 0.0 FROM s WHERE pus IS NULL AND progress < 1
    UNION ALL SELECT traj_id, event_id, 'construction_completed', 0.0 FROM s WHERE progress >= 1 AND (pus IS NULL OR pp < 1)
    UNION ALL SELECT traj_id, event_id, 'destroyed', 0.0 FROM s WHERE destroyed AND pus IS NOT NULL
    UNION ALL SELECT traj_id, event_id, 'last_seen', 0.0 FROM s WHERE nus IS NULL"""


@query("frame_diff", CHANGES_SQL, using="traj")
def frame_diff(spark, sf):
    rows = traj_raw(spark, sf).select(
        "traj_id", "us", "event_id", F.col("event_type").alias("kind"), F.col("value").alias("health"),
        (F.col("k") % 11 / 8.0).alias("progress"), (F.col("k") % 7).cast("double").alias("shield"),
        (F.col("k") % 13 == 0).alias("destroyed"))
    changes = T.frame_changes(rows, ["traj_id"], ORDER, hour_of(), 86_400)
    return changes.select("traj_id", "event_id", "change", F.round("amount", 4).alias("amount"))


@query("previous_frame", """
    SELECT event_id, coalesce(lag(value) OVER (PARTITION BY traj_id ORDER BY us, event_id), value) AS previous FROM traj""",
       using="traj")
def previous_frame(spark, sf):
    rows = blocked_window(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), lags={"_was": F.col("value")})
    return rows.select("event_id", F.coalesce("_was", "value").alias("previous"))


@query("first_attacked", """
    SELECT traj_id, min(us) FILTER (value > 100 AND event_type = 'error') AS first_attacked FROM traj GROUP BY traj_id""",
       using="traj")
def first_attacked(spark, sf):
    hit = (F.col("value") > 100) & (F.col("event_type") == "error")
    return traj_raw(spark, sf).groupBy("traj_id").agg(F.min(F.when(hit, F.col("us"))).alias("first_attacked"))


@query("trailing_count", """
    SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY us RANGE BETWEEN 3600000000 PRECEDING
        AND CURRENT ROW) AS recent FROM traj""", using="traj")
def trailing_count(spark, sf):
    rows = T.trailing_count(traj_raw(spark, sf).select("event_type", "event_id", "us"), ["event_type"], 3600)
    return rows.select("event_id", "recent")


@query("resource_delta", """
    SELECT traj_id, round(sum(greatest(coalesce(p, 500) - value, 0)), 4) AS mined FROM (
        SELECT traj_id, value, lag(value) OVER (PARTITION BY traj_id ORDER BY us, event_id) AS p FROM traj) GROUP BY traj_id""",
       using="traj")
def resource_delta(spark, sf):
    rows = blocked_window(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), lags={"_was": F.col("value")})
    drop = F.greatest(F.coalesce("_was", F.lit(500.0)) - F.col("value"), F.lit(0.0))
    return rows.groupBy("traj_id").agg(F.round(F.sum(drop), 4).alias("mined"))


@query("unseen_resources", f"""
    SELECT traj_id, round(greatest(0, arg_max(value, us) * 1000 - ({NOW} - max(us)) / 1e6 * 0.95 * 12), 2) AS left_over
    FROM traj WHERE us <= {NOW} GROUP BY traj_id""", using="traj")
def unseen_resources(spark, sf):
    last = traj_raw(spark, sf).filter(F.col("us") <= NOW).groupBy("traj_id").agg(
        F.max_by("value", "us").alias("v"), F.max("us").alias("at"))
    expected = F.col("v") * 1000 - (F.lit(NOW) - F.col("at")) / 1e6 * 0.95 * 12
    return last.select("traj_id", F.round(F.greatest(F.lit(0.0), expected), 2).alias("left_over"))


@query("free_resources", """
    SELECT traj_id, CAST(round(50 + coalesce(sum(value) FILTER (event_type = 'view'), 0)
        - coalesce(sum(value) FILTER (event_type = 'purchase'), 0)
        - coalesce(sum(value) FILTER (event_type = 'error'), 0)) AS BIGINT) AS free FROM traj GROUP BY traj_id""", using="traj")
def free_resources(spark, sf):
    def total(kind):
        return F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col("value"))), F.lit(0.0))

    left = 50 + total("view") - total("purchase") - total("error")
    return traj_raw(spark, sf).groupBy("traj_id").agg(F.round(left).cast("bigint").alias("free"))


@query("lost_delta", """
    SELECT event_id, round(value - lag(value, 1, 0) OVER (PARTITION BY traj_id ORDER BY us, event_id), 4) AS delta FROM traj""",
       using="traj")
def lost_delta(spark, sf):
    rows = blocked_window(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), lags={"_was": F.col("value")})
    return rows.select("event_id", F.round(F.col("value") - F.coalesce("_was", F.lit(0.0)), 4).alias("delta"))


@query("nth_started", """
    WITH f AS (SELECT traj_id, event_type AS type, k // 10 AS tag, min(us) AS seen,
        arg_min(us / 1e6 - (k % 10) / 10.0 * 46, (us, event_id)) AS start FROM traj GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY traj_id, type ORDER BY seen, tag) AS rn FROM f)
    SELECT t.traj_id, t.type, round(coalesce(start, 1e300), 3) AS third_start FROM
        (SELECT DISTINCT traj_id, event_type AS type FROM traj) t
    LEFT JOIN r ON r.traj_id = t.traj_id AND r.type = t.type AND rn = 3""", using="traj")
def nth_started(spark, sf):
    rows = traj_raw(spark, sf).select(
        "traj_id", F.col("event_type").alias("type"), F.floor(F.col("k") / 10).alias("tag"), "us", "event_id",
        (F.col("us") / 1e6 - F.col("k") % 10 / 10.0 * 46).alias("start"))
    first = first_per_key(rows, ["traj_id", "type", "tag"], [F.col("us"), F.col("event_id")])
    third = top_per_key(first, ["traj_id", "type"], [F.col("us"), F.col("tag")], 3)
    last = third.groupBy("traj_id", "type").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("start", F.struct("us", "tag")).alias("start"))
    return last.select("traj_id", "type", F.round(F.when(F.col("n") == 3, F.col("start")).otherwise(1e300), 3).alias(
        "third_start"))


@query("latest_snapshots", """
    SELECT traj_id, event_id FROM traj
    QUALIFY row_number() OVER (PARTITION BY traj_id ORDER BY us DESC, event_id DESC) <= 10""", using="traj")
def latest_snapshots(spark, sf):
    rows = traj_raw(spark, sf).select("traj_id", "event_id", "us")
    return top_per_key(rows, ["traj_id"], [F.desc("us"), F.desc("event_id")], 10).select("traj_id", "event_id")


@query("defeat_since", """
    WITH f AS (SELECT traj_id, us, event_id, value < 50 AS flag,
        lag(value < 50, 1, false) OVER (PARTITION BY traj_id ORDER BY us, event_id) AS was FROM traj),
    s AS (SELECT *, max(CASE WHEN flag AND NOT was THEN us END) OVER (PARTITION BY traj_id ORDER BY us, event_id) AS b FROM f)
    SELECT event_id, CASE WHEN flag THEN round((us - b) / 1e6, 3) ELSE 0 END AS since FROM s""", using="traj")
def defeat_since(spark, sf):
    rows = T.runs_of(traj_raw(spark, sf), ["traj_id"], ORDER, hour_of(), F.col("value") < 50)
    return rows.select("event_id", F.round("since", 3).alias("since"))


@query("new_upgrades", """
    WITH c AS (SELECT traj_id, event_id, us, [event_type, 'k' || k % 4] AS now FROM traj),
    l AS (SELECT event_id, now, lag(now) OVER (PARTITION BY traj_id ORDER BY us, event_id) AS was FROM c)
    SELECT event_id, array_to_string([x FOR x IN now IF was IS NULL OR NOT list_contains(was, x)], ',') AS upgrades
    FROM l""", using="traj")
def new_upgrades(spark, sf):
    now = F.array("event_type", F.concat(F.lit("k"), (F.col("k") % 4).cast("string")))
    rows = traj_raw(spark, sf).withColumn("now", now)
    rows = blocked_window(rows, ["traj_id"], ORDER, hour_of(), lags={"_was": F.col("now")})
    fresh = F.array_except("now", F.coalesce("_was", F.array().cast("array<string>")))
    return rows.select("event_id", F.concat_ws(",", fresh).alias("upgrades"))
