"""Distances, ranges, zones and groups of units on the map.

Range joins meet on grid cells: one side is copied into the nine cells around
it, so rows only meet rows that can be near. Positions that repeat are
collapsed with a count before any join, which keeps a crowded spot one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.operators.closure import connected_components
from stepforge.operators.pyramid import Between, build, nearest, range_sums, squared
from stepforge.session import cut_lineage


def distance(x: Column, y: Column, px, py) -> Column:
    return F.sqrt(squared(x - px, y - py))


def cell_of(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(float(side)))


def positions(df: DataFrame, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Distinct positions with how many rows share each."""
    return df.groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias(name))


def near_pairs(points: DataFrame, centres: DataFrame, radius: float, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of (x, y) points and (cx, cy) centres at most ``radius`` apart, with ``d2``."""
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spread = centres.withColumn("_o", F.explode(offsets)).select(
        "*", (cell_of(F.col("cx"), radius) + F.col("_o.i")).alias("_gx"),
        (cell_of(F.col("cy"), radius) + F.col("_o.j")).alias("_gy")).drop("_o")
    placed = points.withColumn("_gx", cell_of(F.col("x"), radius)).withColumn("_gy", cell_of(F.col("y"), radius))
    d2 = squared(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))
    joined = placed.join(spread, [*on, "_gx", "_gy"]).withColumn("d2", d2)
    return joined.filter(F.col("d2") <= float(radius) ** 2).drop("_gx", "_gy")


def range_counts(points: DataFrame, centres: DataFrame, centre_keys: Sequence[str], radius: float,
                 inner: float = 0.0) -> DataFrame:
    """Per centre: points inside (``<``), in the ball (``<=``), and between ``inner`` and ``radius``."""
    r2, i2 = float(radius) ** 2, float(inner) ** 2
    found = range_sums(build(points, radius, {"n": F.lit(1)}), centres, centre_keys, {
        "closer": ("n", Between(high=r2)), "in_ball": ("n", Between(high=r2, closed=True)), "between": ("n", Between(i2, r2))})
    return centres.select(*centre_keys).join(found, list(centre_keys), "left").select(
        *centre_keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("closer", "in_ball", "between")])


def zone_cells(cells: DataFrame, seeds: DataFrame, steps: int) -> DataFrame:
    """Zone of every cell (gx, gy) that a seed (zone, gx, gy) reaches in ``steps`` over cells side by side or cornerwise.

    All seeds are flooded together, one ring of cells a round, so a cell takes
    the zone of fewest steps; of equally near ones the least. Cells are those of
    one map, and a round reads and writes its ring alone.
    """
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    walkable = cells.select("gx", "gy").distinct()
    ring = cut_lineage(seeds.groupBy("gx", "gy").agg(F.min("zone").alias("zone")))
    known = ring
    for _ in range(steps):
        next_to = ring.select("zone", "gx", "gy", F.explode(around).alias("_s")).select(
            "zone", (F.col("gx") + F.col("_s.i")).alias("gx"), (F.col("gy") + F.col("_s.j")).alias("gy"))
        ring = cut_lineage(next_to.groupBy("gx", "gy").agg(F.min("zone").alias("zone")).join(walkable, ["gx", "gy"], "left_semi").join(
            known.select("gx", "gy"), ["gx", "gy"], "left_anti"))
        if ring.isEmpty():
            break
        known = known.unionByName(ring)
    return known


def zone_assign(units: DataFrame, zones: DataFrame, radius: float, height_weight: float = 10.0,
                neutral_penalty: float = 5.0, cells: DataFrame | None = None, side: float = 1.0) -> DataFrame:
    """Units with their zone: that of their map cell, else the one of least weighted distance that holds them.

    ``zones`` has zone, cx, cy, height, neutral; ``units`` has tag, x, y, height;
    ``cells`` has zone, gx, gy of the map's labelled cells of ``side``.
    """
    spots = units.groupBy("x", "y", "height").agg(F.count(F.lit(1)).alias("_n"))
    labelled = None
    if cells is not None:
        placed = spots.withColumn("gx", cell_of(F.col("x"), side)).withColumn("gy", cell_of(F.col("y"), side)).join(cells, ["gx", "gy"], "left")
        labelled = placed.filter(F.col("zone").isNotNull()).select("x", "y", "height", "zone")
        spots = placed.filter(F.col("zone").isNull()).select("x", "y", "height")
    weight = (F.sqrt("d2") + F.abs(F.col("height") - F.col("zone_height")) * height_weight
              + F.when(F.col("neutral"), neutral_penalty).otherwise(0.0))
    pairs = near_pairs(spots, zones.withColumnRenamed("height", "zone_height"), radius).withColumn("_w", weight)
    best = pairs.groupBy("x", "y", "height").agg(F.min(F.struct("_w", "zone"))["zone"].alias("zone"))
    return units.join(best if labelled is None else labelled.unionByName(best), ["x", "y", "height"])


def owned_sites(sites: DataFrame, bases: DataFrame, threshold: float) -> DataFrame:
    """Per site the first base closer than the threshold; sites without one fall out."""
    pairs = near_pairs(bases.select("base", "x", "y"), sites, threshold).filter(F.col("d2") < float(threshold) ** 2)
    return pairs.groupBy("site").agg(F.min("base").alias("base"))


def without_match(orders: DataFrame, started: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Build orders whose target is not on a started structure of the same type."""
    targets = orders.select("type", F.col("x").alias("cx"), F.col("y").alias("cy")).distinct()
    near = range_sums(build(started, tolerance, {"n": F.lit(1)}, ["type"]), targets, ["type", "cx", "cy"],
                      {"n": ("n", Between(high=tolerance * tolerance))})
    taken = near.filter("n > 0").select("type", F.col("cx").alias("x"), F.col("cy").alias("y"))
    return orders.join(taken, ["type", "x", "y"], "left_anti")


def danger(points: DataFrame, enemies: DataFrame, max_range: float) -> DataFrame:
    """Danger per point: dps weighted by distance over range, two slopes by relative speed.

    Beyond twice the range the weight is zero. Enemies meet points on cells of
    the power of two that holds twice their own range, so a pair that is joined
    is near in terms of that enemy. ``enemies`` has x, y, range, dps, slower.
    """
    grouped = enemies.filter((F.col("range") >= 1) & (F.col("range") <= max_range)).groupBy("x", "y", "range", "dps", "slower").agg(
        F.count(F.lit(1)).alias("_n")).withColumn("_class", F.ceil(F.log2(2 * F.col("range"))).cast("int"))
    classes = F.sequence(F.lit(1), F.ceil(F.log2(F.lit(2.0 * max_range))).cast("int"))
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    side = F.pow(F.lit(2.0), F.col("_class"))
    around = points.select("point", "cx", "cy", F.explode(classes).alias("_class")).select("*", F.explode(offsets).alias("_o")).select(
        "point", "cx", "cy", "_class", (F.floor(F.col("cx") / side) + F.col("_o.i")).alias("_gx"),
        (F.floor(F.col("cy") / side) + F.col("_o.j")).alias("_gy"))
    placed = grouped.withColumn("_gx", F.floor(F.col("x") / side)).withColumn("_gy", F.floor(F.col("y") / side))
    d = distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"))
    pairs = placed.join(around, ["_class", "_gx", "_gy"]).withColumn("_d", d).filter(F.col("_d") <= 2 * F.col("range"))
    share = F.col("_d") / F.col("range")
    inside = F.col("dps") + (1 - share) * F.col("dps")
    slope = F.when(F.col("slower"), 1.5).otherwise(2.0)
    outside = F.greatest(F.lit(0.0), (slope - share) * F.col("dps"))
    value = F.when(F.col("_d") < F.col("range"), inside).otherwise(outside) * F.col("_n")
    sums = pairs.groupBy("point").agg(F.sum(value).alias("danger"))
    return points.select("point").join(sums, "point", "left").select(
        "point", F.coalesce("danger", F.lit(0.0)).alias("danger"))


def centroid(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def geometric_median(df: DataFrame, keys: Sequence[str], rounds: int = 30, eps: float = 1e-5,
                     per_check: int = 5) -> DataFrame:
    """Point of least summed distance per group, all groups refined together.

    A group keeps its centre once a round moved it by less than ``eps``. Every
    few rounds the small table of centres is checkpointed and tested.
    """
    keys = list(keys)
    spots = cut_lineage(positions(df, keys))
    sums = spots.groupBy(*keys).agg(F.sum(F.col("x") * F.col("n")).alias("sx"),
                                    F.sum(F.col("y") * F.col("n")).alias("sy"), F.sum("n").alias("m"))
    centres = sums.select(*keys, (F.col("sx") / F.col("m")).alias("cx"), (F.col("sy") / F.col("m")).alias("cy"),
                          F.lit(False).alias("done"))
    for number in range(1, rounds + 1):
        d = distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"))
        away = d > 0
        weight = F.when(away, F.col("n") / d)
        parts = spots.join(centres, keys).groupBy(*keys, "cx", "cy", "done").agg(
            F.sum(weight).alias("w"), F.sum(weight * F.col("x")).alias("wx"), F.sum(weight * F.col("y")).alias("wy"),
            F.coalesce(F.sum(F.when(~away, F.col("n"))), F.lit(0)).alias("zeros"))
        tx, ty = F.col("wx") / F.col("w"), F.col("wy") / F.col("w")
        pull = F.sqrt(squared(tx - F.col("cx"), ty - F.col("cy"))) * F.col("w")
        held = F.when(pull == 0, 0.0).otherwise(F.col("zeros") / pull)
        stay = F.when(F.col("zeros") == 0, 0.0).otherwise(F.least(F.lit(1.0), held))
        nx, ny = (1 - stay) * tx + stay * F.col("cx"), (1 - stay) * ty + stay * F.col("cy")
        fixed = F.col("done") | F.col("w").isNull()
        moved = parts.select(*keys, "cx", "cy", fixed.alias("fixed"), nx.alias("nx"), ny.alias("ny"))
        near = distance(F.col("nx"), F.col("ny"), F.col("cx"), F.col("cy")) < eps
        centres = moved.select(
            *keys, F.when(F.col("fixed"), F.col("cx")).otherwise(F.col("nx")).alias("cx"),
            F.when(F.col("fixed"), F.col("cy")).otherwise(F.col("ny")).alias("cy"),
            (F.col("fixed") | near).alias("done"))
        if number % per_check == 0:
            centres = cut_lineage(centres)
            if centres.filter(~F.col("done")).isEmpty():
                break
    return centres.select(*keys, F.col("cx").alias("x"), F.col("cy").alias("y"))


def _box(prefix: str) -> list[Column]:
    return [F.min("x").alias(f"{prefix}x0"), F.max("x").alias(f"{prefix}x1"),
            F.min("y").alias(f"{prefix}y0"), F.max("y").alias(f"{prefix}y1")]


def eps_groups(points: DataFrame, eps: float, on: Sequence[str] = (), height: str | None = None,
               height_gap: float = 10.0) -> DataFrame:
    """Groups of points linked by steps of at most ``eps``: (x, y) with ``group``.

    Cells are so small that all points of one cell are linked, so cells are the
    nodes. Two cells are linked if any two of their points are near enough.
    Boxes of an eighth of a cell settle that for most; pairs of boxes that leave
    it open are refined to boxes of a quarter of the side, round by round, until
    one pair of a cell is surely near or none can be: a box of one point settles
    all, so points are never joined to points. With ``height`` (one of a map's
    few levels) a link also needs heights within ``height_gap``. ``group`` is
    one cell of the group.
    """
    on = list(on)
    side = eps / 2 ** 0.5 * (1 - 1e-12)
    e2 = eps * eps
    spots = points.select(*on, "x", "y", (F.col(height) if height else F.lit(0)).alias("h")).distinct()
    for name, axis, width in (("gx", "x", side), ("gy", "y", side), ("bx", "x", side / 8), ("by", "y", side / 8)):
        spots = spots.withColumn(name, cell_of(F.col(axis), width))
    spots = cut_lineage(spots)

    own = {"h": "h2", "gx": "gx2", "gy": "gy2", "bx": "bx2", "by": "by2", "px": "px2", "py": "py2",
           "ax0": "bx0", "ax1": "bx1", "ay0": "by0", "ay1": "by1"}

    def as_other(df):
        return df.select(*[F.col(c).alias(own.get(c, c)) for c in df.columns])

    boxes = spots.groupBy(*on, "h", "gx", "gy", "bx", "by").agg(*_box("a"))
    # Half of the cells around a cell, and the cell itself for other heights.
    half = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) >= (0, 0)]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in half])
    reach = boxes.withColumn("_s", F.explode(steps)).withColumn("gx2", F.col("gx") + F.col("_s.i")).withColumn(
        "gy2", F.col("gy") + F.col("_s.j")).drop("_s")
    zero = F.lit(0.0)
    low = squared(F.greatest(F.col("bx0") - F.col("ax1"), F.col("ax0") - F.col("bx1"), zero),
                  F.greatest(F.col("by0") - F.col("ay1"), F.col("ay0") - F.col("by1"), zero))
    high = squared(F.greatest(F.col("bx1") - F.col("ax0"), F.col("ax1") - F.col("bx0")),
                   F.greatest(F.col("by1") - F.col("ay0"), F.col("ay1") - F.col("by0")))
    same_cell = (F.col("gx") == F.col("gx2")) & (F.col("gy") == F.col("gy2"))
    levels = (F.abs(F.col("h") - F.col("h2")) <= height_gap) & (~same_cell | (F.col("h") < F.col("h2")))
    ends = [*on, "h", "gx", "gy", "h2", "gx2", "gy2"]
    met, sure, width = reach.join(as_other(boxes), [*on, "gx2", "gy2"]).filter(levels), None, side / 8
    while True:
        pairs = cut_lineage(met.filter(low <= e2).select(*ends, "bx", "by", "bx2", "by2", (high <= e2).alias("sure")))
        found = pairs.filter("sure").select(*ends).distinct()
        sure = found if sure is None else sure.unionByName(found)
        undecided = cut_lineage(pairs.join(found, ends, "left_anti").select(
            *ends, *[F.col(c).alias(p) for c, p in (("bx", "px"), ("by", "py"), ("bx2", "px2"), ("by2", "py2"))]))
        if undecided.isEmpty():
            break
        width /= 4
        # Only cells with an open pair are cut finer.
        cells = undecided.select(*on, "h", "gx", "gy").unionByName(
            undecided.select(*on, F.col("h2").alias("h"), F.col("gx2").alias("gx"), F.col("gy2").alias("gy"))).distinct()
        finer = spots.join(cells, [*on, "h", "gx", "gy"], "left_semi").withColumn("bx", cell_of(F.col("x"), width)).withColumn(
            "by", cell_of(F.col("y"), width)).groupBy(*on, "h", "gx", "gy", "bx", "by").agg(*_box("a")).withColumn(
            "px", F.floor(F.col("bx") / 4)).withColumn("py", F.floor(F.col("by") / 4))
        met = undecided.join(finer, [*on, "h", "gx", "gy", "px", "py"]).join(as_other(finer), [*on, "h2", "gx2", "gy2", "px2", "py2"])

    node = F.struct(*on, "h", "gx", "gy")
    far_end = F.struct(*on, F.col("h2").alias("h"), F.col("gx2").alias("gx"), F.col("gy2").alias("gy"))
    links = sure.select(node.alias("a"), far_end.alias("b"))
    labels = connected_components(spots.select(node.alias("node")).distinct(), links)
    level = [F.col("h").alias(height)] if height else []
    return spots.select(*on, "x", "y", *level, node.alias("node")).join(labels, "node").select(
        *on, "x", "y", *([height] if height else []), F.col("component").alias("group"))


def merge_groups(points: DataFrame, reach: float, on: Sequence[str] = (), height_gap: float = 10.0) -> DataFrame:
    """Groups ``(on, group, n, x, y)`` of points whose centres drew together, with the mean of their points as centre.

    ``points`` has ``on``, id, x, y, height. Points on one spot and level begin as
    one group. In every round each group looks for the nearest other centre within
    ``reach`` whose heights all lie within ``height_gap`` of its own, and two groups
    that found each other merge (ties go to the smaller id); centres move, so a
    chain longer than the reach does not become one group. Ends when none merges.
    A group is named by its least id. Each round is a k-nearest join that
    looks at few cells for each centre.
    """
    on = list(on)
    groups = cut_lineage(points.groupBy(*on, "x", "y", "height").agg(F.min("id").alias("group"), F.count(F.lit(1)).alias("n")).select(
        *on, "group", "n", (F.col("x") * F.col("n")).alias("sx"), (F.col("y") * F.col("n")).alias("sy"), F.col("height").alias("low"), F.col("height").alias("high")))
    while True:
        placed = groups.withColumn("cx", F.col("sx") / F.col("n")).withColumn("cy", F.col("sy") / F.col("n"))
        # Levels are few, so are the stretches of heights that groups span.
        spans = placed.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("low").alias("from_height"), F.col("high").alias("to_height")).distinct()
        fits = F.greatest("high", "to_height") - F.least("low", "from_height") <= height_gap
        for c in on:
            fits = fits & (F.col(c) == F.col(f"_{c}"))
        asked = placed.join(spans, fits).select(*on, "group", "cx", "cy", "from_height", "to_height")
        others = placed.select(*on, F.col("group").alias("near"), F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("low").alias("from_height"), F.col("high").alias("to_height"))
        found = nearest(others, asked, ["group", "from_height", "to_height"], 2, "near", [*on, "from_height", "to_height"])
        close = found.filter((F.col("near") != F.col("group")) & (F.col("d2") <= float(reach) ** 2))
        best = cut_lineage(close.groupBy("group").agg(F.min(F.struct("d2", "near"))["near"].alias("near")))
        back = best.select(F.col("near").alias("group"), F.col("group").alias("near"))
        pairs = cut_lineage(best.join(back, ["group", "near"]).filter("near < group"))
        if pairs.isEmpty():
            return placed.select(*on, "group", "n", F.col("cx").alias("x"), F.col("cy").alias("y"))
        moved = groups.join(pairs, "group", "left").withColumn("group", F.coalesce("near", "group"))
        groups = cut_lineage(moved.groupBy(*on, "group").agg(
            F.sum("n").alias("n"), F.sum("sx").alias("sx"), F.sum("sy").alias("sy"), F.min("low").alias("low"), F.max("high").alias("high")))


def flood_regions(cells: DataFrame) -> DataFrame:
    """Regions of cells (x, y) that touch at a side or corner, as ``region`` = one of its cells."""
    node = F.struct("x", "y")
    half = [(1, -1), (1, 0), (1, 1), (0, 1)]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in half])
    cells = cells.select("x", "y").distinct()
    next_to = cells.withColumn("_s", F.explode(steps)).select(
        F.col("x").alias("ox"), F.col("y").alias("oy"), (F.col("x") + F.col("_s.i")).alias("x"),
        (F.col("y") + F.col("_s.j")).alias("y"))
    links = next_to.join(cells, ["x", "y"]).select(
        F.struct(F.col("ox").alias("x"), F.col("oy").alias("y")).alias("a"), node.alias("b"))
    labels = connected_components(cells.select(node.alias("node")), links)
    return labels.select("node.x", "node.y", F.col("component").alias("region"))
