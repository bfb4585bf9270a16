"""Exact best inner products by cover trees over queries and data together.

Vectors are scaled, floored to integers and dealt to cells around centres of a
sample. Every query first scores the sample itself, which gives a kth score it
surely reaches; it then goes only to the cells whose ball could hold a better
row. A task holds a chunk of a cell and a chunk of its queries, builds a tree
over each and walks them together, pruning pairs of nodes against the worst
kth score of the query node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepforge.llm.cells import SAMPLE, by_size, distances, matrix, pivots, usable
from stepforge.llm.common import Scratch
from stepforge.llm.covertree import CoverTree, best_scores

MEMBERS, GUESTS, CELL = 16_384, 8_192, 8_192


def top_products(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
                 scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for every row whose id is divisible by ``every``.

    The score is the integer inner product of ``floor(scale * x)``; ties go to
    the smaller id. Only vectors of one length meet. Rows without an id, and
    vectors that are null, empty or hold a null or a number that is not finite, take
    no part. Of rows that share an id the least vector counts. Integers must
    stay below 2**53 in a product, as they do for components up to a million.
    Other columns are not read; fewer than k candidates give fewer rows.
    """
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.filter(usable("vec") & F.col("id").isNotNull()).groupBy("id").agg(F.min("vec").alias("vec"))
    rows = scratch.cut(rows.select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("double")).alias("vec"), F.lit(0).alias("g")))
    centers = pivots(rows, "g", "vec", lambda x: x, CELL)
    sample = rows.orderBy(F.xxhash64("vec", "g")).limit(SAMPLE).select("id", "vec").collect()
    held: dict[int, tuple] = {}
    for size in {len(r.vec) for r in sample}:
        own = [r for r in sample if len(r.vec) == size]
        held[size] = np.array([r.id for r in own]), np.array([r.vec for r in own])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            cell, far = np.full(len(sizes), -1, np.int32), np.zeros(len(sizes))
            for size, at in by_size(sizes):
                if (0, size) in centers:
                    low, c = centers[0, size]
                    d = distances(matrix(batch.column(1).take(pa.array(at)), size), c)
                    cell[at], far[at] = low + d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far), pa.array(sizes)], ["id", "vec", "cell", "far", "size"])

    placed = scratch.cut(rows.select("id", "vec").mapInArrow(assign, "id long, vec array<double>, cell int, far double, size int"))
    # At most one row per centre, so at most as many as the sample has.
    radius = {r.cell: r.far for r in placed.filter("cell >= 0").groupBy("cell").agg(F.max("far").alias("far")).collect()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, take, to, floors = batch.column(0).to_numpy(), [], [], []
            for size, at in by_size(batch.column(4).to_numpy()):
                x = matrix(batch.column(1).take(pa.array(at)), size)
                floor = np.full(len(at), -np.inf)
                if size in held and len(held[size][0]) > k:
                    for low in range(0, len(at), 1024):
                        met = x[low:low + 1024] @ held[size][1].T
                        met[ids[at[low:low + 1024]][:, None] == held[size][0][None, :]] = -np.inf
                        floor[low:low + 1024] = np.partition(met, met.shape[1] - k, axis=1)[:, -k]
                if (0, size) in centers:
                    low, c = centers[0, size]
                    ball = np.array([radius.get(low + i, -np.inf) for i in range(len(c))])
                    live = np.flatnonzero(ball >= 0)
                    top = x @ c[live].T + np.sqrt((x * x).sum(axis=1))[:, None] * ball[live][None, :]
                    q, y = np.nonzero(top * (1 + 1e-9 * np.sign(top)) + 1e-6 >= floor[:, None])
                    take.append(at[q])
                    to.append((low + live[y]).astype(np.int32))
                    floors.append(floor[q])
                else:
                    take.append(at)
                    to.append(np.full(len(at), -1, np.int32))
                    floors.append(floor)
            if take:
                index = pa.array(np.concatenate(take))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(index), batch.column(1).take(index), batch.column(4).take(index), pa.array(np.concatenate(to)),
                     pa.array(np.concatenate(floors))], ["id", "vec", "size", "cell", "floor"])

    asked = scratch.cut(placed.filter(F.col("id") % every == 0).mapInArrow(ask, "id long, vec array<double>, size int, cell int, floor double"))
    group = ["size", "cell"]
    cut = scratch.cut(placed.groupBy(*group).agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("c")).join(
        asked.groupBy(*group).agg(F.ceil(F.count("*") / GUESTS).cast("int").alias("v")), group))
    until = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    members = placed.select("id", "vec", *group, F.lit(0).alias("s"), F.lit(None).cast("double").alias("floor")).join(cut, group).withColumn(
        "i", F.pmod(F.xxhash64("id"), "c").cast("int")).withColumn("j", F.explode(until("v")))
    guests = asked.select("id", "vec", *group, F.lit(1).alias("s"), "floor").join(cut, group).withColumn(
        "j", F.pmod(F.xxhash64("id"), "v").cast("int")).withColumn("i", F.explode(until("c")))
    tasks = members.drop("c", "v").unionByName(guests.drop("c", "v"))

    def search(key: tuple[pa.Scalar, ...], data: pa.Table) -> pa.Table:
        size, side = key[0].as_py(), data["s"].to_numpy()
        x, ids = matrix(data["vec"].combine_chunks(), size), data["id"].to_numpy()
        own, asking = side == 0, side == 1
        floor = data["floor"].to_numpy()[asking]
        scores, found = best_scores(CoverTree(x[asking]), CoverTree(x[own]), ids[asking], ids[own], k, floor)
        hit = found >= 0
        rows = np.nonzero(hit)[0]
        return pa.table({"query_id": ids[asking][rows], "vec_id": found[hit], "score": scores[hit].astype(np.int64)})

    best = tasks.groupBy(*group, "i", "j").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
