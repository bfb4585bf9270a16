"""Batch forms of state that a frame loop would keep.

Long histories are cut into blocks of time (see ``ordered``), so no operator
needs the whole history of a key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepforge.operators.chains import follow, later_positions
from stepforge.operators.ordered import blocked_window, even_blocks, numbered
from stepforge.session import cut_lineage

SECOND = 1_000_000


def last_seen(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, seen: Column,
              time: str = "us") -> DataFrame:
    """Seconds since the condition last held, null before it first did."""
    out = blocked_window(rows, keys, order, block, last_known={"_at": F.when(seen, F.col(time))})
    return out.withColumn("seconds_since", (F.col(time) - F.col("_at")) / SECOND).withColumn("last_at", F.col("_at")).drop("_at")


def expiring(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, written: Column,
             max_age: float, time: str = "us") -> DataFrame:
    """Add ``value`` of the latest write while it is younger than ``max_age`` seconds."""
    write = F.when(written.isNotNull(), F.struct(F.col(time).alias("at"), written.alias("value")))
    out = blocked_window(rows, keys, order, block, last_known={"_write": write})
    fresh = F.col(time) - F.col("_write.at") < F.lit(int(max_age * SECOND))
    return out.withColumn("visible", F.when(fresh, F.col("_write.value"))).drop("_write")


def trailing_count(rows: DataFrame, keys: Sequence[str], seconds: int, time: str = "us", most: int = 1 << 20) -> DataFrame:
    """Add ``recent``: rows of the key in the last ``seconds``, the current one and those of its instant included.

    One running number over the instants of a key, each counted where it comes
    and taken off again just after it is too old: the difference of two running
    numbers in one order, without a range frame. No block holds more than about
    ``most`` instants.
    """
    keys, reach = list(keys), seconds * SECOND
    instants = rows.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n"))
    moves = instants.select(*keys, F.inline(F.array(
        F.struct(F.col(time).alias("_t"), F.lit(0).alias("_kind"), F.col("_n").alias("_by")),
        F.struct((F.col(time) + reach).alias("_t"), F.lit(1).alias("_kind"), (-F.col("_n")).alias("_by")))))
    placed = even_blocks(moves, keys, "_t", reach, most)
    summed = blocked_window(placed, keys, ["_t", "_kind"], F.col("_even"), sums={"recent": F.col("_by")})
    return rows.join(summed.filter("_kind = 0").select(*keys, F.col("_t").alias(time), "recent"), [*keys, time])


def commits(issued: DataFrame, seen: DataFrame, keys: Sequence[str], wait: float, time: str = "us") -> DataFrame:
    """Issued actions with the first confirmation within ``wait`` seconds, else null.

    Issues and confirmations are put in one order per key and every issue takes
    the next confirmation, its own time included: no pairs are made and equal
    issues stay rows of their own. Keys and times are non-null.
    """
    width = int(wait * SECOND)
    asked = issued.withColumns({"_kind": F.lit(0), "_seen": F.lit(None).cast("bigint")})
    found = seen.select(*keys, time, F.lit(1).alias("_kind"), F.col(time).alias("_seen"))
    both = asked.unionByName(found, allowMissingColumns=True)
    out = blocked_window(both, keys, [time, "_kind"], F.floor(F.col(time) / width), next_known={"_next": F.col("_seen")})
    hit = F.col("_next") <= F.col(time) + width
    return out.filter("_kind = 0").select(*issued.columns, F.when(hit, F.col("_next")).alias("committed"))


def accepted_issues(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, wait: float,
                    time: str = "us") -> DataFrame:
    """Issues that were not ignored because the same key was still pending.

    ``rows`` has ``committed`` from ``commits``. An accepted issue is pending
    until it was confirmed or ``wait`` went by; the first issue later than that
    is accepted next.
    """
    until = F.coalesce("committed", F.col(time) + int(wait * SECOND))
    return _kept_in_turn(rows, keys, order, block, until, False, int(wait * SECOND), time)


def sample_interval(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, seconds: float, time: str = "us") -> DataFrame:
    """Rows kept when at least ``seconds`` passed since the last kept row of the key; its first row is kept."""
    width = int(seconds * SECOND)
    return _kept_in_turn(rows, keys, order, block, F.col(time) + width, True, width, time)


def _kept_in_turn(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, until: Column, same: bool, width: int,
                  time: str) -> DataFrame:
    """The first row of each key, then always the first one that reaches ``until`` of the one kept before."""
    placed = cut_lineage(numbered(rows, keys, order, block, "seq"))
    jumps = later_positions(placed, keys, time, until, width, same=same)
    return placed.join(follow(jumps, keys).select(*keys, "seq"), [*keys, "seq"], "left_semi").select(*rows.columns)


FOLD = 1024


def clamp_fold(rows: DataFrame, keys: Sequence[str], order: Sequence[str], width: int, a: Column, b: Column,
               low: Column, high: Column, start: float = 0.0, most: int = 1 << 20) -> DataFrame:
    """Fold ``h -> min(high, max(low, a * h + b))`` over a key's rows in order.

    Such steps compose to one of the same form. Rows are numbered in blocks of
    about equal size (``order`` begins with a time in whole numbers, ``width`` of
    it is a block until it holds ``most`` rows), and then folded ``FOLD`` at a
    time, first rows, then the steps that came of them, until a key has one: no
    list is longer than ``FOLD``. Rows are read twice for their numbers.
    """
    keys = list(keys)
    step = F.struct(*[c.cast("double").alias(n) for n, c in (("a", a), ("b", b), ("lo", low), ("hi", high))])
    identity = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(float("-inf")).alias("lo"),
                        F.lit(float("inf")).alias("hi"))

    def clamp(x, s):
        return F.least(s["hi"], F.greatest(s["lo"], x))

    def then(f, g):
        scaled = lambda x: F.when(g["a"] == 0, g["b"]).otherwise(g["a"] * x + g["b"])
        return F.struct((g["a"] * f["a"]).alias("a"), scaled(f["b"]).alias("b"),
                        clamp(scaled(f["lo"]), g).alias("lo"), clamp(scaled(f["hi"]), g).alias("hi"))

    narrow = even_blocks(rows.select(*keys, *order, step.alias("step")), keys, order[0], width, most)
    steps = numbered(narrow, keys, order, F.col("_even")).select(*keys, "seq", "step")
    while True:
        entry = F.struct("seq", "step")
        steps = cut_lineage(
            steps.groupBy(*keys, F.floor(F.col("seq") / FOLD).alias("block"))
            .agg(F.array_sort(F.collect_list(entry)).alias("_l"))
            .select(*keys, F.col("block").alias("seq"), F.aggregate("_l", identity, lambda f, e: then(f, e["step"])).alias("step")))
        if steps.filter("seq > 0").isEmpty():
            break
    value = clamp(F.col("step.a") * start + F.col("step.b"), F.col("step"))
    return steps.select(*keys, value.alias("value"))


def frame_changes(frames: DataFrame, unit: Sequence[str], order: Sequence[str], block: Column, gap: int,
                  time: str = "us") -> DataFrame:
    """Change events of a unit between its successive sightings.

    ``frames`` has kind, health, shield, progress and destroyed; a pause above
    ``gap`` seconds means that the unit left view and came back. Damage is the
    sum of what health and shield lost; a unit first seen whole is completed.
    """
    state = F.struct(time, "kind", "health", "shield", "progress")
    rows = blocked_window(frames, unit, order, block, lags={"_was": state}, leads={"_next": F.col(time)})
    was, wide = F.col("_was"), gap * SECOND
    changed = [
        ("created", was.isNull(), F.lit(0.0)),
        ("entered_view", F.col(time) - was[time] > wide, F.lit(0.0)),
        ("left_view", F.col("_next") - F.col(time) > wide, F.lit(0.0)),
        ("damaged", (F.col("health") < was["health"]) | (F.col("shield") < was["shield"]),
         was["health"] - F.col("health") + was["shield"] - F.col("shield")),
        ("type_changed", F.col("kind") != was["kind"], F.lit(0.0)),
        ("construction_started", was.isNull() & (F.col("progress") < 1), F.lit(0.0)),
        ("construction_completed", (F.col("progress") >= 1) & (was.isNull() | (was["progress"] < 1)), F.lit(0.0)),
        ("destroyed", F.col("destroyed") & was.isNotNull(), F.lit(0.0)),
        ("last_seen", F.col("_next").isNull(), F.lit(0.0)),
    ]
    events = F.array_compact(F.array(*[
        F.when(when, F.struct(F.lit(name).alias("change"), amount.alias("amount"))) for name, when, amount in changed]))
    return rows.select(*unit, *order, F.explode(events).alias("_e")).select(
        *unit, *order, F.col("_e.change").alias("change"), F.col("_e.amount").alias("amount"))


def runs_of(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, flag: Column,
            time: str = "us") -> DataFrame:
    """Add ``since``: seconds the flag has held without a break, 0 where it does not."""
    marked = rows.withColumn("_flag", flag)
    was = blocked_window(marked, keys, order, block, lags={"_was": F.col("_flag")})
    start = F.when(F.col("_flag") & ~F.coalesce("_was", F.lit(False)), F.col(time))
    out = blocked_window(was, keys, order, block, last_known={"_begin": start})
    held = F.when(F.col("_flag"), (F.col(time) - F.col("_begin")) / SECOND).otherwise(F.lit(0.0))
    return out.withColumn("since", held).drop("_flag", "_was", "_begin")


def ghosts(sightings: DataFrame, keys: Sequence[str], now: int, air_age: float, ground_age: float) -> DataFrame:
    """Last known state of unseen units at ``now`` (microseconds).

    ``sightings`` has us, kind (seen, empty, destroyed), flying, burrowed,
    detected and payload columns. A unit is dropped when it expired, was
    destroyed, or its place was seen empty; a burrowed one stays unless a
    detector was near.
    """
    rest = [c for c in sightings.columns if c not in keys]
    seen = F.col("kind") == "seen"
    past = sightings.filter(F.col("us") <= now)
    latest = past.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.when(seen, F.col("us"))).alias("_last"),
        F.max(F.when(F.col("kind") == "destroyed", F.col("us"))).alias("_dead"),
        F.max(F.when(F.col("kind") == "empty", F.col("us"))).alias("_empty"),
        F.max(F.when((F.col("kind") == "empty") & F.col("detected"), F.col("us"))).alias("_searched"))
    last = F.col("_last")
    age = (F.lit(now) - last["us"]) / SECOND
    limit = F.when(last["flying"], air_age).otherwise(ground_age)
    emptied = F.when(last["burrowed"], F.col("_searched")).otherwise(F.col("_empty")) > last["us"]
    kept = latest.filter(last.isNotNull() & F.col("_dead").isNull() & (age > 0) & (age <= limit)
                         & ~F.coalesce(emptied, F.lit(False)))
    return kept.select(*keys, *[last[c].alias(c) for c in rest], age.alias("age"))
