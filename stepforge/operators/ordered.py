"""Ordered operators whose key may hold a large share of all rows.

A plain window sends every row of a key to one task. Here the rows of a key are
cut into blocks along the order (an hour, a range of ids). Each block is
summarised before the shuffle, the small block table is scanned in order, and
what the earlier blocks leave behind is joined back. The heavy window then runs
per (key, block), so its largest group is one block and not one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.session import cut_lineage

BLOCK = "_block"
CUTS = 256


def blocked_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    *,
    number: str | None = None,
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    minima: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    leads: Mapping[str, Column] | None = None,
    last_known: Mapping[str, Column] | None = None,
    next_known: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running columns over each key in ascending ``order``.

    ``block`` must not decrease along ``order`` and must be non-null, as must
    the keys. ``number`` is the dense position from 0; ``sums``, ``maxima`` and
    ``minima`` include the current row; ``lags`` and ``leads`` read the
    neighbouring row; ``last_known`` is the latest non-null value so far and
    ``next_known`` the first one from the current row on.
    """
    keys, order = list(keys), list(order)
    sums, maxima, minima = dict(sums or {}), dict(maxima or {}), dict(minima or {})
    lags, leads, known = dict(lags or {}), dict(leads or {}), dict(last_known or {})
    ahead = dict(next_known or {})
    rows = df.withColumn(BLOCK, block)
    at = F.struct(*order)

    summary, carry = [], {}
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(1, Window.unboundedFollowing)
    beside = Window.partitionBy(*keys).orderBy(BLOCK)

    def keep(name, aggregate, over):
        summary.append(aggregate.alias(f"_s_{name}"))
        carry[f"_c_{name}"] = over(F.col(f"_s_{name}"))

    if number:
        keep(number, F.count(F.lit(1)), lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)))
    for name, value in sums.items():
        keep(name, F.sum(value), lambda c: F.sum(c).over(before))
    for name, value in maxima.items():
        keep(name, F.max(value), lambda c: F.max(c).over(before))
    for name, value in minima.items():
        keep(name, F.min(value), lambda c: F.min(c).over(before))
    for name, value in lags.items():
        keep(name, F.max_by(F.struct(value.alias("v")), at), lambda c: F.lag(c).over(beside))
    for name, value in leads.items():
        keep(name, F.min_by(F.struct(value.alias("v")), at), lambda c: F.lead(c).over(beside))
    for name, value in known.items():
        keep(name, F.max_by(value, F.when(value.isNotNull(), at)),
             lambda c: F.last(c, ignorenulls=True).over(before))

    for name, value in ahead.items():
        keep(name, F.min_by(value, F.when(value.isNotNull(), at)),
             lambda c: F.first(c, ignorenulls=True).over(after))

    blocks = rows.groupBy(*keys, BLOCK).agg(*summary)
    blocks = blocks.select(*keys, BLOCK, *[c.alias(n) for n, c in carry.items()])
    out = rows.join(blocks, [*keys, BLOCK])

    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {}
    if number:
        added[number] = F.row_number().over(inside) - 1 + F.col(f"_c_{number}")
    for name, value in sums.items():
        carried, own = F.col(f"_c_{name}"), F.sum(value).over(so_far)
        added[name] = F.coalesce(carried + own, own, carried)
    for name, value in maxima.items():
        added[name] = F.greatest(F.col(f"_c_{name}"), F.max(value).over(so_far))
    for name, value in minima.items():
        added[name] = F.least(F.col(f"_c_{name}"), F.min(value).over(so_far))
    for name, value in lags.items():
        own = F.lag(F.struct(value.alias("v"))).over(inside)
        added[name] = F.coalesce(own, F.col(f"_c_{name}"))["v"]
    for name, value in leads.items():
        own = F.lead(F.struct(value.alias("v"))).over(inside)
        added[name] = F.coalesce(own, F.col(f"_c_{name}"))["v"]
    for name, value in known.items():
        own = F.last(value, ignorenulls=True).over(so_far)
        added[name] = F.coalesce(own, F.col(f"_c_{name}"))
    for name, value in ahead.items():
        own = F.first(value, ignorenulls=True).over(inside.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        added[name] = F.coalesce(own, F.col(f"_c_{name}"))
    return out.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column,
             name: str = "seq") -> DataFrame:
    """Dense position from 0 per key."""
    return blocked_window(df, keys, order, block, number=name)


def even_blocks(df: DataFrame, keys: Sequence[str], time: str, width: int, most: int, name: str = "_even") -> DataFrame:
    """Add blocks along ``time`` (a whole number): of ``width``, and cut finer where a key is crowded.

    Only (key, width) cells of more than ``most`` rows are looked at twice: a
    quantile sketch cuts them into up to 256 blocks of about equal rows, at most
    twice ``most`` each up to that number. Rows of one instant stay together.
    The sizes of the cells are read when the plan is built; if none is crowded,
    nothing is joined, else the cuts, a row for each crowded cell, are written out.
    """
    keys = list(keys)
    cell = F.floor(F.col(time) / F.lit(width))
    rows = df.withColumn("_cell", cell)
    sizes = rows.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= most:
        return df.withColumn(name, F.struct(cell.alias("_cell"), F.lit(0).alias("part")))
    crowded = sizes.filter(F.col("_n") > most)
    wanted = F.least(F.lit(CUTS), F.ceil(F.col("_n") / most).cast("int"))
    sketch = F.percentile_approx(time, [i / CUTS for i in range(1, CUTS)], 4 * CUTS)
    cuts = rows.join(crowded, [*keys, "_cell"]).groupBy(*keys, "_cell", "_n").agg(sketch.alias("_q")).select(
        *keys, "_cell", F.array_distinct(F.transform(
            F.sequence(F.lit(1), wanted - 1), lambda i: F.get("_q", F.floor(i * CUTS / wanted).cast("int") - 1))).alias("_cuts"))
    placed = rows.join(cut_lineage(cuts), [*keys, "_cell"], "left")
    part = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(time))), F.lit(0))
    return placed.withColumn(name, F.struct("_cell", F.when(F.col("_cuts").isNull(), 0).otherwise(part).alias("part"))).drop("_cell", "_cuts")
