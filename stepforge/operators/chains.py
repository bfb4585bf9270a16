"""Following jumps through an ordered key, without the key in one task.

Greedy rules over an ordered sequence (keep a row, skip what it covers, keep
the next) are jumps: every position knows the later position that comes next if
it is kept, and the kept ones are those reached from the first. A key is cut
into blocks of positions. Inside a block the jumps are doubled until each
position knows where its chain leaves the block; across blocks only positions
that some chain enters are carried, and blocks are merged pairwise, which
leaves ever fewer entries. The one chain from position 0 is then refined back
down to the blocks and listed there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.operators.ordered import blocked_window, even_blocks
from stepforge.session import cut_lineage

BLOCK_ROWS = 4096


def follow(jumps: DataFrame, keys: Sequence[str], size: int = BLOCK_ROWS) -> DataFrame:
    """``(keys, hop, seq, to)`` of the positions reached from 0, numbered by ``hop``.

    ``jumps`` has non-null keys, dense ``seq`` from 0 per key and ``to``, a later
    position or any number beyond the last; a null ``to`` ends the chain. No
    group holds more than ``size`` positions (a power of two).
    """
    keys = list(keys)
    last = F.lit(1 << 62)
    entry = F.struct("seq", F.coalesce(F.col("to").cast("bigint"), last).alias("to"))
    blocks = cut_lineage(
        jumps.select(*keys, F.col("seq").cast("bigint").alias("seq"), "to").withColumn("block", F.floor(F.col("seq") / size))
        .groupBy(*keys, "block").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["to"]).alias("to")))
    base, end = F.col("block") * size, F.col("block") * size + F.size("to")
    top = blocks.agg(F.max("block")).first()[0]
    levels = max(0, math.ceil(math.log2(top + 1))) if top is not None else 0
    entries = blocks.filter("block = 0").select(*keys, F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("hop"))
    if levels:
        edges = [cut_lineage(_block_exits(blocks, keys, base, end, size))]
        for level in range(1, levels):
            edges.append(cut_lineage(_merged(edges[-1], keys, size << level)))
        for level in range(levels, 0, -1):
            into = entries.join(edges[level - 1], [*keys, "at"])
            inside = F.floor(F.col("exit") / (size << level)) == F.floor(F.col("at") / (size << level))
            entries = entries.unionByName(into.filter(inside).select(
                *keys, F.col("exit").alias("at"), (F.col("hop") + F.col("hops")).alias("hop")))
            # Each level at most doubles the entries; written out, they are not worked out twice at the next one.
            entries = cut_lineage(entries) if level > 1 else entries
    entries = entries.withColumn("block", F.floor(F.col("at") / size))
    listed = blocks.join(entries, [*keys, "block"]).filter(F.col("at") < end)
    pair = "array<struct<seq:bigint,to:bigint>>"
    start = F.struct(F.col("at").alias("at"), F.array().cast(pair).alias("kept"))

    def walk(state, _):
        target = F.get("to", (state["at"] - base).cast("int"))
        return F.when(state["at"] < end, F.struct(target.alias("at"), F.concat(state["kept"], F.array(
            F.struct(state["at"].alias("seq"), target.alias("to")))).alias("kept"))).otherwise(state)

    kept = F.aggregate(F.sequence(F.lit(1), F.size("to")), start, walk)["kept"]
    return listed.select(*keys, "hop", F.posexplode(kept).alias("_i", "_k")).select(
        *keys, (F.col("hop") + F.col("_i")).alias("hop"), "_k.seq", F.when(F.col("_k.to") < last, F.col("_k.to")).alias("to"))


def _block_exits(blocks: DataFrame, keys: list[str], base, end, size: int) -> DataFrame:
    """Where the chain of every entered position leaves its block, and after how many hops."""
    once = F.transform("to", lambda t: F.struct(t.alias("at"), F.lit(1).cast("bigint").alias("hops")))

    def twice(known, _):
        def on(x):
            further = F.get(known, (x["at"] - base).cast("int"))
            return F.when(x["at"] < end, F.struct(further["at"].alias("at"), (x["hops"] + further["hops"]).alias("hops"))).otherwise(x)

        return F.transform(known, on)

    far = blocks.select(*keys, "block", F.aggregate(F.sequence(F.lit(1), F.lit(int(math.log2(size)))), once, twice).alias("far"))
    far = cut_lineage(far)
    entered = far.select(*keys, F.explode(F.array_distinct(F.transform("far", lambda x: x["at"]))).alias("at"))
    entered = entered.filter(F.col("at") < F.lit(1 << 62)).unionByName(
        far.filter("block = 0").select(*keys, F.lit(0).cast("bigint").alias("at"))).distinct()
    found = entered.withColumn("block", F.floor(F.col("at") / size)).join(far, [*keys, "block"])
    found = found.withColumn("_x", F.get("far", (F.col("at") - base).cast("int"))).filter("_x is not null")
    return found.select(*keys, "at", F.col("_x.at").alias("exit"), F.col("_x.hops").alias("hops"))


def _merged(edges: DataFrame, keys: list[str], span: int) -> DataFrame:
    """Exits of blocks of ``span`` positions from the exits of their halves, for the positions still entered."""
    onward = edges.select(*keys, F.col("at").alias("exit"), F.col("exit").alias("_exit"), F.col("hops").alias("_hops"))
    inside = F.floor(F.col("exit") / span) == F.floor(F.col("at") / span)
    joined = cut_lineage(edges.withColumn("_in", inside).join(onward, [*keys, "exit"], "left").select(
        *keys, "at", F.when(F.col("_in"), F.coalesce("_exit", "exit")).otherwise(F.col("exit")).alias("exit"),
        F.when(F.col("_in"), F.col("hops") + F.coalesce("_hops", F.lit(0))).otherwise(F.col("hops")).alias("hops")))
    entered = joined.select(*keys, F.col("exit").alias("at")).distinct()
    return joined.join(entered, [*keys, "at"], "left_semi").unionByName(joined.filter("at = 0"))


def later_positions(rows: DataFrame, keys: Sequence[str], time: str, at, width: int, *, same: bool, most: int = 1 << 20) -> DataFrame:
    """``(keys, seq, to)``: the first position whose ``time`` reaches ``at`` of each row.

    ``rows`` has dense ``seq`` in the order of ``time``. With ``same`` a row at
    exactly ``at`` counts. Rows and questions are put in one order and every
    question takes the next row, so no pairs are made; ``to`` is null if none follows.
    """
    keys = list(keys)
    none = F.lit(None).cast("bigint")
    own = rows.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.col("seq").alias("_s"), F.col("seq").alias("_known"))
    asked = rows.select(*keys, at.alias("_t"), F.lit(0 if same else 2).alias("_kind"), F.col("seq").alias("_s"), none.alias("_known"))
    both = even_blocks(own.unionByName(asked), keys, "_t", width, most)
    out = blocked_window(both, keys, ["_t", "_kind", "_s"], F.col("_even"), next_known={"to": F.col("_known")})
    return out.filter("_kind <> 1").select(*keys, F.col("_s").alias("seq"), "to")
