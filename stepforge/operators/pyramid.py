"""Positions summed on a pyramid of cells, and range and nearest joins that descend it.

Level 0 has square cells of one side, each next level cells of an eighth of the
side, but only inside cells that hold many positions. A join keeps pairs of a
centre and a cell and settles them by the box around the cell's positions: a
cell wholly in range adds its sums, a cell wholly out of range is dropped, and
only cells at the border go on to their children and in the end to their
positions. The pairs of a centre follow the length of its border and not the
number of positions around it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.session import cut_lineage

FAN = 8
LEAF = 64
DEPTH = 12


@dataclass
class Pyramid:
    """``levels`` of cells and the positions (``leaves``) of the cells that have no children."""

    on: list[str]
    values: list[str]
    side: float
    levels: list[DataFrame]
    leaves: DataFrame


def squared(dx: Column, dy: Column) -> Column:
    return dx * dx + dy * dy


def build(points: DataFrame, side: float, values: Mapping[str, Column], on: Sequence[str] = (), leaf: int = LEAF) -> Pyramid:
    """Pyramid over (x, y), one for each ``on``, with sums of ``values``.

    A cell of more than ``leaf`` distinct positions has children, to a depth
    where a side is below any distance that matters; equal positions are one.
    """
    on, names = list(on), list(values)
    spots = cut_lineage(points.groupBy(*on, "x", "y").agg(*[F.sum(v).alias(n) for n, v in values.items()]))
    levels, leaves, rows, width = [], [], spots, float(side)
    for level in range(DEPTH):
        rows = rows.withColumn("gx", F.floor(F.col("x") / F.lit(width))).withColumn("gy", F.floor(F.col("y") / F.lit(width)))
        parent = [F.floor(F.col("gx") / FAN).alias("px"), F.floor(F.col("gy") / FAN).alias("py")]
        cells = cut_lineage(rows.groupBy(*on, "gx", "gy").agg(
            F.count(F.lit(1)).alias("m"), *[F.sum(n).alias(n) for n in names], F.min("x").alias("x0"), F.max("x").alias("x1"),
            F.min("y").alias("y0"), F.max("y").alias("y1")).withColumn("open", F.col("m") > leaf).select("*", *parent))
        levels.append(cells if level + 1 < DEPTH else cells.withColumn("open", F.lit(False)))
        placed = rows.join(levels[-1].select(*on, "gx", "gy", "open"), [*on, "gx", "gy"])
        leaves.append(placed.filter(~F.col("open")).select(F.lit(level).alias("level"), *on, "gx", "gy", "x", "y", *names))
        if levels[-1].filter("open").isEmpty():
            break
        rows = placed.filter("open").select(*spots.columns)
        width /= FAN
    whole = leaves[0]
    for part in leaves[1:]:
        whole = whole.unionByName(part)
    return Pyramid(on, names, float(side), levels, whole)


def _bounds() -> tuple[Column, Column]:
    """Least and greatest squared distance of (cx, cy) from a cell's box."""
    def near(c, a, b):
        return F.greatest(F.col(a) - F.col(c), F.col(c) - F.col(b), F.lit(0.0))

    def far(c, a, b):
        return F.greatest(F.abs(F.col(c) - F.col(a)), F.abs(F.col(b) - F.col(c)))

    return (squared(near("cx", "x0", "x1"), near("cy", "y0", "y1")), squared(far("cx", "x0", "x1"), far("cy", "y0", "y1")))


@dataclass
class Between:
    """Squared distances of a stretch; open ends do not count."""

    low: float = -1.0
    high: float = float("inf")
    closed: bool = False

    def holds(self, d2: Column) -> Column:
        return (d2 > self.low) & ((d2 <= self.high) if self.closed else (d2 < self.high))

    def misses(self, low: Column, high: Column) -> Column:
        return (high <= self.low) | ((low > self.high) if self.closed else (low >= self.high))


def range_sums(tree: Pyramid, centres: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, Between]]) -> DataFrame:
    """``keys`` and for each wanted name the sum of a value over the positions at such distances.

    ``centres`` has distinct ``keys``, cx, cy and the tree's ``on``; centres
    without any position in range fall out. No distance exceeds the tree's side.
    """
    keys, on = list(keys), tree.on
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    held = list(dict.fromkeys([*keys, *on, "cx", "cy"]))
    around = centres.select(*held, F.explode(offsets).alias("_o")).select(
        *held, (F.floor(F.col("cx") / tree.side) + F.col("_o.i")).alias("gx"), (F.floor(F.col("cy") / tree.side) + F.col("_o.j")).alias("gy"))
    states = around.join(tree.levels[0], [*on, "gx", "gy"])
    low, high = _bounds()
    parts = []
    for level in range(len(tree.levels)):
        judged = cut_lineage(states.withColumn("_low", low).withColumn("_high", high).select(
            *held, "gx", "gy", "open", *tree.values, "_low", "_high"))
        inside = {n: b.holds(F.col("_low")) & b.holds(F.col("_high")) for n, (_, b) in wanted.items()}
        settled = F.lit(True)
        for n, (_, b) in wanted.items():
            settled = settled & (inside[n] | b.misses(F.col("_low"), F.col("_high")))
        parts.append(judged.filter(settled).select(*keys, *[F.when(inside[n], F.col(v)).alias(n) for n, (v, _) in wanted.items()]))
        border = judged.filter(~settled)
        spots = tree.leaves.filter(F.col("level") == level).drop("level")
        met = border.filter(~F.col("open")).select(*held, "gx", "gy").join(spots, [*on, "gx", "gy"])
        d2 = squared(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))
        parts.append(met.select(*keys, *[F.when(b.holds(d2), F.col(v)).alias(n) for n, (v, b) in wanted.items()]))
        if level + 1 < len(tree.levels):
            states = border.filter("open").select(*held, F.col("gx").alias("px"), F.col("gy").alias("py")).join(
                tree.levels[level + 1], [*on, "px", "py"])
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in wanted])


def nearest(points: DataFrame, centres: DataFrame, keys: Sequence[str], k: int, tie: str, on: Sequence[str] = (), leaf: int = LEAF) -> DataFrame:
    """The ``k`` points nearest to each centre, ties by ``tie``, as ``keys``, the points' columns, ``d2`` and ``rank`` from 1.

    ``points`` has x, y, ``tie`` and ``on``; ``centres`` distinct ``keys``, cx, cy
    and ``on``; names that begin with an underscore are the join's own. Cells are taken from one that holds all points down to the
    positions; those farther away than the bound that nearer cells set for the
    kth point are dropped at every level, so a centre keeps few cells however
    crowded or empty its surroundings are. Centres on one position have the same
    points, so the cells are searched once for each position and the points joined to its centres.
    """
    keys, on = list(keys), list(on)
    others = [c for c in points.columns if c not in on]
    clash = [c for c in others if c in keys]
    if clash:
        raise ValueError(f"centres and points share the columns {clash}")
    whole = points.agg(F.max(F.greatest(F.abs("x"), F.abs("y")))).first()[0]
    side = 1.0
    while whole is not None and side <= whole:
        side *= 2
    # Around the origin at most four cells hold all points of a group, so this join makes four rows a centre.
    tree = build(points.withColumn("_all", F.lit(0)), side, {"n": F.lit(1)}, [*on, "_all"], leaf)
    held = [*on, "cx", "cy"]
    places = centres.select(*held).distinct()
    cell = ["level", "gx", "gy", "n", "open", "_low", "_high"]
    low, high = _bounds()

    def judged(states):
        """States without the cells that the kth nearest point cannot lie in."""
        each = Window.partitionBy(*held)
        upto = F.sum("n").over(each.orderBy("_high", "level", "gx", "gy"))
        bound = F.min(F.when(F.col("_upto") >= k, F.col("_high"))).over(each)
        return states.withColumn("_upto", upto).withColumn("_bound", bound).filter(
            F.col("_bound").isNull() | (F.col("_low") <= F.col("_bound"))).drop("_upto", "_bound")

    def joined(states, level, columns):
        return states.join(tree.levels[level], columns).select(
            *held, F.lit(0).alias("_all"), F.lit(level).alias("level"), "gx", "gy", "n", "open", low.alias("_low"), high.alias("_high"))

    states = cut_lineage(judged(joined(places.withColumn("_all", F.lit(0)), 0, [*on, "_all"])))
    for level in range(1, len(tree.levels)):
        children = joined(states.filter("open").select(*held, "_all", F.col("gx").alias("px"), F.col("gy").alias("py")), level, [*on, "_all", "px", "py"])
        states = cut_lineage(judged(states.filter(~F.col("open")).select(*held, "_all", *cell).unionByName(children)))
    d2 = squared(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))
    spots = states.select(*held, "_all", "level", "gx", "gy").join(tree.leaves, [*on, "_all", "level", "gx", "gy"]).select(
        *held, "x", "y", "level", "gx", "gy", "n", d2.alias("_low"), d2.alias("_high"))
    found = judged(spots).select(*held, "x", "y", F.col("_low").alias("d2"))
    # Of points on one position only the first k can be wanted.
    here = F.row_number().over(Window.partitionBy(*on, "x", "y").orderBy(tie))
    firsts = points.withColumn("_here", here).filter(F.col("_here") <= k).drop("_here")
    rank = F.row_number().over(Window.partitionBy(*held).orderBy("d2", tie))
    ranked = found.join(firsts, [*on, "x", "y"]).withColumn("rank", rank).filter(F.col("rank") <= k)
    ranked = ranked.select(*[F.col(c).alias(f"_at_{c}") for c in held], *others, "d2", "rank")
    same = F.col("cx").eqNullSafe(F.col("_at_cx")) & F.col("cy").eqNullSafe(F.col("_at_cy"))
    for c in on:
        same = same & (F.col(c) == F.col(f"_at_{c}"))
    asked = list(dict.fromkeys([*on, *keys]))
    return centres.select(*dict.fromkeys([*asked, "cx", "cy"])).join(ranked, same).select(*asked, *others, "d2", "rank")
