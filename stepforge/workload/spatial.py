"""Positions of parts as units on the map."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.operators import picking as K
from stepforge.operators import spatial as S
from stepforge.operators.keyed import top_per_key
from stepforge.operators.pyramid import nearest
from stepforge.workload.registry import query
from stepforge.workload.views import pos, table

# Nations stand for zones: a fixed number of places that does not follow the data.
ZONES_SQL = """zones AS (SELECT n_nationkey AS zone, CAST(n_nationkey * 31 % 200 AS DOUBLE) AS cx,
    CAST(n_nationkey * 47 % 200 AS DOUBLE) AS cy, n_regionkey % 3 AS height, n_nationkey % 2 = 0 AS neutral FROM nation)"""


def zones(spark, sf):
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        key.cast("bigint").alias("zone"), (key * 31 % 200).cast("double").alias("cx"),
        (key * 47 % 200).cast("double").alias("cy"), (F.col("n_regionkey") % 3).alias("height"),
        (key % 2 == 0).alias("neutral"))


@query("within_range", f"""
    WITH {ZONES_SQL} SELECT zone, count(*) FILTER (d < 900) AS closer, count(*) FILTER (d <= 900) AS in_ball,
           count(*) FILTER (d > 100 AND d < 900) AS between
    FROM (SELECT zone, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS d FROM zones, pos) GROUP BY zone""", using="pos")
def within_range(spark, sf):
    return S.range_counts(pos(spark, sf), zones(spark, sf), ["zone"], 30.0, 10.0)


@query("further_than", """
    SELECT tag, type FROM pos WHERE (x - 100) * (x - 100) + (y - 100) * (y - 100) > 8100""", using="pos")
def further_than(spark, sf):
    far = S.squared(F.col("x") - 100, F.col("y") - 100) > 90.0 ** 2
    return pos(spark, sf).filter(far).select("tag", "type")


@query("in_distance_of_group", """
    SELECT DISTINCT a.tag FROM pos a JOIN pos b ON b.type = 'PROMO' AND b.size > 48
    WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 64""", using="pos")
def in_distance_of_group(spark, sf):
    units = pos(spark, sf)
    group = units.filter((F.col("type") == "PROMO") & (F.col("size") > 48)).select(
        F.col("x").alias("cx"), F.col("y").alias("cy")).distinct()
    near = S.near_pairs(S.positions(units), group, 8.0).filter(F.col("d2") < 64.0).select("x", "y").distinct()
    return units.join(near, ["x", "y"], "left_semi").select("tag")


@query("nearest_to_centroid", """
    WITH e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY label, i),
    d AS (SELECT vec_id, e.label, round(sqrt(sum((v - m) * (v - m))), 6) AS distance
          FROM e JOIN c ON e.label = c.label AND e.i = c.i GROUP BY vec_id, e.label)
    SELECT vec_id, label, distance FROM d QUALIFY row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) <= 5""")
def nearest_to_centroid(spark, sf):
    rows = table(spark, sf, "embeddings")
    parts = rows.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(
        F.avg(F.col("v").cast("double")).alias("m"))
    centre = parts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))
    gap = F.zip_with("embedding", "c", lambda v, c: (v.cast("double") - c["m"]) * (v.cast("double") - c["m"]))
    total = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda a, g: a + g))
    near = rows.join(centre, "label").select("vec_id", "label", F.round(total, 6).alias("distance"))
    return top_per_key(near, ["label"], [F.col("distance"), F.col("vec_id")], 5)


@query("nearest_k", """
    WITH d AS (SELECT a.tag, b.tag AS near, (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) AS d2,
        row_number() OVER (PARTITION BY a.tag ORDER BY (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y), b.tag) AS rank
        FROM pos a JOIN pos b ON b.type = a.type AND b.size > 5) SELECT tag, near, rank, d2 FROM d WHERE rank <= 5""", using="pos")
def nearest_k(spark, sf):
    units = pos(spark, sf)
    others = units.filter(F.col("size") > 5).select("type", F.col("tag").alias("near"), "x", "y")
    centres = units.select("tag", "type", F.col("x").alias("cx"), F.col("y").alias("cy"))
    return nearest(others, centres, ["tag"], 5, "near", ["type"]).select("tag", "near", "rank", "d2")


@query("furthest_k", """
    SELECT tag, type, round(sqrt((x - 50) * (x - 50) + (y - 50) * (y - 50)), 6) AS distance FROM pos
    QUALIFY row_number() OVER (PARTITION BY type ORDER BY (x - 50) * (x - 50) + (y - 50) * (y - 50) DESC, tag) <= 4""",
       using="pos")
def furthest_k(spark, sf):
    rows = K.furthest(pos(spark, sf), 50, 50, 4, "tag", ["type"])
    return rows.select("tag", "type", F.round(F.sqrt("d2"), 6).alias("distance"))


@query("nearest_to_distance", """
    SELECT tag, round(abs(sqrt((x - 100) * (x - 100) + (y - 100) * (y - 100)) - 25), 6) AS gap FROM pos
    ORDER BY gap, tag LIMIT 12""", using="pos")
def nearest_to_distance(spark, sf):
    return K.nearest_to_distance(pos(spark, sf), 100, 100, 25, 12, "tag").select("tag", "gap")


@query("closest_group", f"""
    WITH {ZONES_SQL} SELECT a.zone, arg_min(b.zone, (sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2), b.zone)) AS nearest
    FROM zones a JOIN zones b ON a.zone <> b.zone
    WHERE (a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2 < 2500 GROUP BY a.zone""")
def closest_group(spark, sf):
    centres = zones(spark, sf)
    others = centres.select(F.col("zone").alias("nearest"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    pairs = S.near_pairs(others, centres, 50.0).filter((F.col("zone") != F.col("nearest")) & (F.col("d2") < 2500.0))
    return pairs.groupBy("zone").agg(F.min(F.struct(F.sqrt("d2").alias("d"), "nearest"))["nearest"].alias("nearest"))


@query("en_route_anti", """
    WITH o AS (SELECT l_orderkey, l_linenumber, type, x, y FROM lineitem JOIN pos ON l_partkey = tag
               WHERE l_returnflag = 'R')
    SELECT type, count(*) AS workers FROM o WHERE NOT EXISTS (SELECT 1 FROM pos s WHERE s.type = o.type AND s.size = 50
        AND (s.x - o.x) * (s.x - o.x) + (s.y - o.y) * (s.y - o.y) < 1) GROUP BY type""", using="pos")
def en_route_anti(spark, sf):
    units = pos(spark, sf)
    orders = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("tag")).join(units, "tag").select("type", "x", "y")
    started = units.filter(F.col("size") == 50)
    return S.without_match(orders, started).groupBy("type").agg(F.count(F.lit(1)).alias("workers"))


STEPS = 3
# Cells of ten by ten with a large unit can be walked; a zone floods from the cell of its middle.
CELLS_SQL = f"""walkable AS (SELECT CAST(floor(x / 10) AS BIGINT) AS gx, CAST(floor(y / 10) AS BIGINT) AS gy FROM pos WHERE size > 44 GROUP BY ALL),
    flood(zone, gx, gy, d) AS (SELECT zone, CAST(floor(cx / 10) AS BIGINT), CAST(floor(cy / 10) AS BIGINT), 0 FROM zones
        UNION SELECT f.zone, w.gx, w.gy, f.d + 1 FROM flood f JOIN walkable w ON abs(w.gx - f.gx) <= 1 AND abs(w.gy - f.gy) <= 1 WHERE f.d < {STEPS}),
    cells AS (SELECT gx, gy, arg_min(zone, (d, zone)) AS zone FROM flood GROUP BY ALL)"""


def zone_map(spark, sf):
    def at(x, y):
        return S.cell_of(F.col(x), 10).alias("gx"), S.cell_of(F.col(y), 10).alias("gy")

    walkable = pos(spark, sf).filter(F.col("size") > 44).select(*at("x", "y"))
    return S.zone_cells(walkable, zones(spark, sf).select("zone", *at("cx", "cy")), STEPS)


@query("zone_cells", f"WITH RECURSIVE {ZONES_SQL}, {CELLS_SQL} SELECT gx, gy, zone FROM cells", using="pos")
def zone_cells(spark, sf):
    return zone_map(spark, sf).select("gx", "gy", "zone")


@query("zone_assign", f"""
    WITH RECURSIVE {ZONES_SQL}, {CELLS_SQL}, w AS (SELECT tag, zone, sqrt((x - cx) ** 2 + (y - cy) ** 2) + abs(size % 3 - height) * 10
               + CASE WHEN neutral THEN 5 ELSE 0 END AS w FROM pos, zones
               WHERE (x - cx) ** 2 + (y - cy) ** 2 <= 900),
    ruled AS (SELECT tag, arg_min(zone, (w, zone)) AS zone FROM w GROUP BY tag)
    SELECT tag, coalesce(c.zone, r.zone) AS zone FROM pos LEFT JOIN cells c ON floor(x / 10) = gx AND floor(y / 10) = gy LEFT JOIN ruled r USING (tag)
    WHERE coalesce(c.zone, r.zone) IS NOT NULL""", using="pos")
def zone_assign(spark, sf):
    units = pos(spark, sf).select("tag", "x", "y", (F.col("size") % 3).alias("height"))
    return S.zone_assign(units, zones(spark, sf), 30.0, cells=zone_map(spark, sf), side=10.0).select("tag", "zone")


@query("owned_sites", f"""
    WITH {ZONES_SQL} SELECT zone AS site, min(tag) AS base FROM zones, pos
    WHERE size > 40 AND (x - cx) ** 2 + (y - cy) ** 2 < 225 GROUP BY zone""", using="pos")
def owned_sites(spark, sf):
    bases = pos(spark, sf).filter(F.col("size") > 40).groupBy("x", "y").agg(F.min("tag").alias("base"))
    return S.owned_sites(zones(spark, sf).withColumnRenamed("zone", "site"), bases, 15.0)


@query("danger_sum", f"""
    WITH {ZONES_SQL}, e AS (SELECT x, y, 4 + size % 5 AS r, price / 1000 AS dps, size % 2 = 0 AS slower FROM pos),
    p AS (SELECT zone AS point, r, dps, slower, sqrt((x - cx) ** 2 + (y - cy) ** 2) / r AS s FROM zones, e)
    SELECT point, round(sum(CASE WHEN s < 1 THEN dps + (1 - s) * dps
        ELSE greatest(0, (CASE WHEN slower THEN 1.5 ELSE 2.0 END - s) * dps) END), 4) AS danger FROM p GROUP BY point""",
       using="pos")
def danger_sum(spark, sf):
    enemies = pos(spark, sf).select(
        "x", "y", (4 + F.col("size") % 5).cast("double").alias("range"), (F.col("price") / 1000).alias("dps"),
        (F.col("size") % 2 == 0).alias("slower"))
    points = zones(spark, sf).select(F.col("zone").alias("point"), "cx", "cy")
    return S.danger(points, enemies, 8.0).select("point", F.round("danger", 4).alias("danger"))


@query("centroid", """
    SELECT type, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM pos GROUP BY type""", using="pos")
def centroid(spark, sf):
    rows = S.centroid(pos(spark, sf), ["type"])
    return rows.select("type", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("geometric_median", """
    WITH m AS (SELECT type, 0 AS i, avg(x) AS cx, avg(y) AS cy, false AS done FROM pos GROUP BY type
    UNION ALL
    SELECT type, i + 1, CASE WHEN done THEN cx ELSE nx END, CASE WHEN done THEN cy ELSE ny END,
           done OR sqrt((nx - cx) ** 2 + (ny - cy) ** 2) < 1e-5
    FROM (SELECT m.type, any_value(m.i) AS i, m.cx, m.cy, any_value(m.done) AS done,
                 sum(p.x / sqrt((p.x - m.cx) ** 2 + (p.y - m.cy) ** 2)) / sum(1 / sqrt((p.x - m.cx) ** 2 + (p.y - m.cy) ** 2)) AS nx,
                 sum(p.y / sqrt((p.x - m.cx) ** 2 + (p.y - m.cy) ** 2)) / sum(1 / sqrt((p.x - m.cx) ** 2 + (p.y - m.cy) ** 2)) AS ny
          FROM m JOIN pos p ON p.type = m.type WHERE m.i < 30 GROUP BY m.type, m.cx, m.cy))
    SELECT type, round(cx, 3) AS x, round(cy, 3) AS y FROM m WHERE i = 30""", using="pos")
def geometric_median(spark, sf):
    rows = S.geometric_median(pos(spark, sf), ["type"])
    return rows.select("type", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


LINKED = """spots AS (SELECT type, x, y, {height} AS h, min(tag) AS spot FROM pos GROUP BY ALL),
    links AS (SELECT a.spot AS a, b.spot AS b FROM spots a JOIN spots b ON a.type = b.type AND abs(a.h - b.h) <= 10
              AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {limit}),
    groups(spot, group_id) USING KEY (spot) AS (
        SELECT spot, spot FROM spots
        UNION (SELECT l.a, min(n.group_id) FROM links l JOIN recurring.groups n ON l.b = n.spot
               JOIN recurring.groups o ON l.a = o.spot WHERE n.group_id < o.group_id GROUP BY l.a)),
    members AS (SELECT pos.*, group_id FROM pos JOIN spots s ON s.type = pos.type AND s.x = pos.x AND s.y = pos.y
                AND s.h = {height} JOIN groups USING (spot))"""


def grouped_units(units, eps, height=None):
    """Units with the group of their position; a group is named by its least tag."""
    level = [height] if height else []
    joined = units.join(S.eps_groups(units, eps, ["type"], height), ["type", "x", "y", *level])
    names = joined.groupBy("group").agg(F.min("tag").alias("group_id"), F.count(F.lit(1)).alias("members"),
                                        F.avg("x").alias("gx"), F.avg("y").alias("gy"))
    return joined, names


@query("eps_groups", "WITH RECURSIVE " + LINKED.format(height=0, limit=49) + """
    SELECT tag, group_id FROM members""", using="pos")
def eps_groups(spark, sf):
    joined, names = grouped_units(pos(spark, sf), 7.0)
    return joined.join(names, "group").select("tag", "group_id")


@query("level_groups", "WITH RECURSIVE " + LINKED.format(height="size // 10 * 8", limit=110.25) + """
    SELECT group_id, count(*) AS members, round(avg(x), 4) AS x, round(avg(y), 4) AS y
    FROM members GROUP BY group_id HAVING count(*) <= 12""", using="pos")
def level_groups(spark, sf):
    units = pos(spark, sf).withColumn("level", F.floor(F.col("size") / 10) * 8)
    _, names = grouped_units(units, 10.5, "level")
    return names.filter(F.col("members") <= 12).select(
        "group_id", "members", F.round("gx", 4).alias("x"), F.round("gy", 4).alias("y"))


@query("merge_resources", """
    WITH RECURSIVE g AS (SELECT 0 AS r, type, min(tag) AS id, count(*) AS n, sum(x) AS sx, sum(y) AS sy, size // 10 * 8 AS low, size // 10 * 8 AS high
            FROM pos GROUP BY type, x, y, size // 10 * 8
        UNION ALL
        SELECT r + 1, type, into_id, CAST(sum(n) AS BIGINT), sum(sx), sum(sy), min(low), max(high) FROM (
            WITH near AS (SELECT a.id, arg_min(b.id, ((a.sx / a.n - b.sx / b.n) * (a.sx / a.n - b.sx / b.n) + (a.sy / a.n - b.sy / b.n) * (a.sy / a.n - b.sy / b.n), b.id)) AS near
                    FROM g a JOIN g b ON a.type = b.type AND a.id <> b.id AND greatest(a.high, b.high) - least(a.low, b.low) <= 10
                        AND (a.sx / a.n - b.sx / b.n) * (a.sx / a.n - b.sx / b.n) + (a.sy / a.n - b.sy / b.n) * (a.sy / a.n - b.sy / b.n) <= 110.25 GROUP BY a.id),
                pairs AS (SELECT a.id, a.near FROM near a JOIN near b ON a.near = b.id AND b.near = a.id)
            SELECT g.*, least(g.id, coalesce(p.near, g.id)) AS into_id FROM g LEFT JOIN pairs p ON p.id = g.id WHERE EXISTS (SELECT 1 FROM pairs))
        GROUP BY r, type, into_id)
    SELECT id AS group_id, n AS members, round(sx / n, 4) AS x, round(sy / n, 4) AS y FROM g WHERE r = (SELECT max(r) FROM g) AND n <= 12""", using="pos")
def merge_resources(spark, sf):
    units = pos(spark, sf).select("type", F.col("tag").alias("id"), "x", "y", (F.floor(F.col("size") / 10) * 8).alias("height"))
    return S.merge_groups(units, 10.5, ["type"]).filter("n <= 12").select(
        F.col("group").alias("group_id"), F.col("n").alias("members"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("region_label", """
    WITH cells AS (SELECT CAST(floor(x / 10) AS BIGINT) AS x, CAST(floor(y / 10) AS BIGINT) AS y, count(*) AS n FROM pos
                   GROUP BY ALL HAVING max(size) > 46),
    keyed AS (SELECT x, y, x * 1000 + y AS k FROM cells),
    reach(a, b) AS (SELECT k, k FROM keyed UNION SELECT r.a, n.k FROM reach r JOIN keyed m ON r.b = m.k
                    JOIN keyed n ON abs(n.x - m.x) <= 1 AND abs(n.y - m.y) <= 1)
    SELECT x, y, min(b) AS region FROM reach JOIN keyed ON k = a GROUP BY x, y""", using="pos")
def region_label(spark, sf):
    cells = pos(spark, sf).groupBy(S.cell_of(F.col("x"), 10).alias("x"), S.cell_of(F.col("y"), 10).alias("y")).agg(
        F.max("size").alias("size")).filter(F.col("size") > 46)
    regions = S.flood_regions(cells)
    # A region is named by its least cell.
    names = regions.groupBy("region").agg(F.min(F.col("x") * 1000 + F.col("y")).alias("name"))
    return regions.join(names, "region").select("x", "y", F.col("name").alias("region"))


@query("argmax_cell", """
    SELECT type, arg_max(cell, (heat, -cell)) AS cell, max(heat) AS heat FROM (
        SELECT type, CAST(floor(x / 5) * 100 + floor(y / 5) AS BIGINT) AS cell, CAST(sum(greatest(size - 25, 0)) AS BIGINT) AS heat
        FROM pos GROUP BY ALL) WHERE heat > 0 GROUP BY type""", using="pos")
def argmax_cell(spark, sf):
    cell = S.cell_of(F.col("x"), 5) * 100 + S.cell_of(F.col("y"), 5)
    heat = pos(spark, sf).groupBy("type", cell.alias("cell")).agg(
        F.sum(F.greatest(F.col("size") - 25, F.lit(0))).alias("heat")).filter(F.col("heat") > 0)
    return heat.groupBy("type").agg(
        F.max_by("cell", F.struct("heat", -F.col("cell"))).alias("cell"), F.max("heat").alias("heat"))


@query("sort_by_distance", """
    SELECT tag, (x - 20) * (x - 20) + (y - 180) * (y - 180) AS d2 FROM pos ORDER BY d2 DESC, tag""", using="pos")
def sort_by_distance(spark, sf):
    d2 = S.squared(F.col("x") - 20, F.col("y") - 180)
    return pos(spark, sf).select("tag", d2.alias("d2")).orderBy(F.desc("d2"), "tag")


@query("proxy_flag", """
    SELECT type, bool_or((x - 30) * (x - 30) + (y - 30) * (y - 30) < 3600) AS proxy FROM pos
    WHERE size > 47 GROUP BY type""", using="pos")
def proxy_flag(spark, sf):
    near = S.squared(F.col("x") - 30, F.col("y") - 30) < 60.0 ** 2
    return pos(spark, sf).filter(F.col("size") > 47).groupBy("type").agg(F.bool_or(near).alias("proxy"))
