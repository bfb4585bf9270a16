"""Time, angles and the remaining keys on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions import numbers as N
from stepforge.functions import text as X
from stepforge.operators import listing as L
from stepforge.plans import battle as B
from stepforge.sources.files import array_rows
from stepforge.workload.aggregations import CLASSED_ITEMS, order_items
from stepforge.workload.graph_rows import graph
from stepforge.workload.registry import query
from stepforge.workload.scans import EDGES_SQL, used
from stepforge.workload.texts import GEN_SQL, gen, trim_sql
from stepforge.workload.views import cand_lists, pos, units


@query("time_convert", """
    SELECT game, tag, line, round(us / 1e6 / 16.0 * 22.4, 4) AS new_ticks, round(us / 1e6 / 22.4 * 16.0, 4) AS old_ticks,
        round(size / 22.4, 6) AS seconds, round(us / 1e6 - progress * size, 4) AS started,
        round(us / 1e6 + (1 - progress) * size, 4) AS finished FROM units""", using="units")
def time_convert(spark, sf):
    now, progress, size = F.col("us") / 1e6, F.col("progress"), F.col("size")
    return units(spark, sf).select(
        "game", "tag", "line", F.round(N.to_new_ticks(now), 4).alias("new_ticks"), F.round(N.to_old_ticks(now), 4).alias("old_ticks"),
        F.round(N.frame_seconds(size), 6).alias("seconds"), F.round(N.started_at(now, progress, size), 4).alias("started"),
        F.round(N.finished_at(now, progress, size), 4).alias("finished"))


@query("angle_math", """
    WITH a AS (SELECT tag, x, y, atan2(y - 100, x - 100) AS a, size * 0.7e0 AS b FROM pos),
    w AS (SELECT *, CASE WHEN b - 2 * pi() * floor(b / (2 * pi())) > pi() THEN b - 2 * pi() * floor(b / (2 * pi())) - 2 * pi()
        ELSE b - 2 * pi() * floor(b / (2 * pi())) END AS wb FROM a)
    SELECT tag, round(wb, 6) AS wrapped, round(CASE WHEN abs(wb - a) <= pi() THEN abs(wb - a) ELSE 2 * pi() - abs(wb - a) END, 6)
        AS apart, round(CASE WHEN x = 0 AND y = 0 THEN 0 ELSE x / sqrt(x * x + y * y) END, 6) AS nx FROM w""", using="pos")
def angle_math(spark, sf):
    a, b = F.atan2(F.col("y") - 100, F.col("x") - 100), F.col("size") * 0.7
    return pos(spark, sf).select("tag", F.round(N.wrap_angle(b), 6).alias("wrapped"),
                                 F.round(N.angle_distance(a, b), 6).alias("apart"),
                                 F.round(N.normalised(F.col("x"), F.col("y"))["x"], 6).alias("nx"))


@query("extract_cot", f"WITH {GEN_SQL} SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN {trim_sql('u')} ELSE '' END AS cot FROM gen",
       using="sample")
def extract_cot(spark, sf):
    return gen(spark, sf).select("conv_id", X.extract_cot(F.col("raw")).alias("cot"))


@query("multiset_label", f"""
    WITH {CLASSED_ITEMS} SELECT index, string_agg(CASE WHEN n > 1 THEN name || 'x' || n ELSE name END, ', ' ORDER BY name) AS label
    FROM pairs GROUP BY index""")
def multiset_label(spark, sf):
    return order_items(spark, sf).select("index", L.multiset_label(F.col("items")).alias("label"))


@query("can_feed", """
    SELECT game, type, cost, cost <= 0 OR cost <= supply_left AS can_feed FROM (SELECT game, type, CAST(size % 4 AS BIGINT) AS cost,
        min(line) - 2 AS supply_left FROM units GROUP BY game, type, size % 4)""", using="units")
def can_feed(spark, sf):
    rows = units(spark, sf).groupBy("game", "type", (F.col("size") % 4).alias("cost")).agg(
        (F.min("line") - 2).alias("supply_left"))
    return rows.select("game", "type", "cost", B.affordable(F.col("cost"), F.col("supply_left")).alias("can_feed"))


@query("derive_researches", f"""WITH {EDGES_SQL}
    SELECT unit AS subject, 'researches' AS relation, result AS object, n FROM executor JOIN ability a USING (ability)
    JOIN used USING (ability) WHERE kind = 'Research'""", using="traj ability executor")
def derive_researches(spark, sf):
    from stepforge.plans.graph import produces

    edges = produces(graph(spark, "executor"), graph(spark, "ability")).filter(F.col("relation") == "researches")
    return edges.join(used(spark, sf), "ability").drop("ability")


@query("scan_sample_array", """
    SELECT prompt, place AS index, 'pick ' || tag AS system, unit AS human FROM cand_list""", using="cand_list")
def scan_sample_array(spark, sf):
    # Every list is written as one JSON array text and read back by position.
    turn = F.struct(F.lit("human").alias("from"), F.col("unit").alias("value"))
    one = F.struct(F.concat(F.lit("pick "), F.col("tag").cast("string")).alias("system"), F.array(turn).alias("conversations"))
    texts = cand_lists(spark, sf, one.alias("s")).select("prompt", F.to_json(F.transform("l", lambda e: e["s"])).alias("value"))
    rows = array_rows(texts, ["prompt"])
    return rows.select("prompt", "index", "system", F.col("conversations")[0]["value"].alias("human"))
