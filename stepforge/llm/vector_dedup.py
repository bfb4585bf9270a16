"""Near-duplicate embeddings within a label by a walk of cover trees in pairs.

The first level of the tree is spread over the cluster: cells around centres
drawn from a sample, every vector in the cell of its nearest centre. A vector
also visits each later cell of its label whose ball, of the measured radius,
it could reach into. Cells are cut into chunks, so that a task holds a
bounded number of members and of visitors, and every pair of vectors within
reach meets in exactly one task, where trees over both sides are walked
together and what is left is compared in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm.cells import distances, matrix, pivots, unit, usable
from stepforge.llm.common import Scratch, components, union
from stepforge.llm.covertree import CoverTree, near_pairs

MEMBERS, VISITORS, CELL = 4096, 8192, 2048


def _compare(own: np.ndarray, own_weight: np.ndarray, other, other_weight, cosine: float, inner: bool):
    """Link counts and class roots over both sides from all pairs at ``cosine`` or more."""
    n, m = len(own), len(other)
    links, roots = np.zeros(n + m, np.int64), np.arange(n + m)
    reach = float(np.sqrt(max(2.0 - 2.0 * cosine, 0.0))) + 1e-6
    a, weight = CoverTree(own), np.concatenate([own_weight, other_weight])
    both = np.concatenate([own, other])

    def meet(rows, cols, shift, same):
        nonlocal roots
        for low in range(0, len(rows), 1024):
            part = rows[low:low + 1024]
            x, y = np.nonzero(both[part] @ both[cols + shift].T >= cosine - 1e-12)
            x, y = part[x], cols[y] + shift
            if same:
                keep = x < y
                x, y = x[keep], y[keep]
            exact = np.einsum("ij,ij->i", both[x], both[y]) >= cosine
            x, y = x[exact], y[exact]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            apart = roots[x] != roots[y]
            if apart.any():
                roots = union(roots, x[apart], y[apart])

    if inner:
        for rows, cols in near_pairs(a, a, reach):
            meet(rows, cols, 0, rows is cols or np.array_equal(rows, cols))
    if m:
        b = CoverTree(other)
        for rows, cols in near_pairs(a, b, reach):
            meet(rows, cols, n, False)
    return links, roots


def vector_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                      cosine: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row.

    Rows are compared when their labels are equal and not null and their
    vectors have one length. A vector that is null, empty or zero, or holds a
    null or a number that is not finite, links with nothing, and a row that
    links with nothing is its own component. Equal vectors of a label are compared once and
    count as often as they occur. ``component_id`` is the smallest id
    reachable; a null id is never the smallest, and repeated ids count as
    rows of their own. Other columns are not read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("ok", usable("vec") & F.col("label").isNotNull() & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)))
    good = rows.filter("ok").select("vec_id", "label", "vec")
    distinct = scratch.cut(good.groupBy("label", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
                           .withColumn("row", F.monotonically_increasing_id()))
    centers = pivots(distinct, "label", "vec", unit, CELL)
    flat = {key: (low, c) for key, (low, c) in centers.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, sizes = batch.column(2).to_pylist(), batch.column(3).value_lengths().to_numpy()
            cell, far = np.full(len(sizes), -1, np.int32), np.zeros(len(sizes))
            groups: dict = {}
            for i, key in enumerate(zip(labels, sizes.tolist())):
                groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                if key in flat:
                    low, c = flat[key]
                    d = distances(unit(matrix(batch.column(3).take(pa.array(at)), key[1])), c)
                    cell[at], far[at] = low + d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], ["row", "copies", "label", "vec", "cell", "far"])

    placed = scratch.cut(distinct.select("row", "copies", "label", "vec").mapInArrow(
        assign, "row long, copies long, label string, vec array<double>, cell int, far double"))
    # At most one row per centre, so at most as many as the sample has.
    radius = {r.cell: r.far for r in placed.filter("cell >= 0").groupBy("cell").agg(F.max("far").alias("far")).collect()}
    reach = float(np.sqrt(max(2.0 - 2.0 * cosine, 0.0))) + 1e-6

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            take, to, side = [np.arange(n)], [batch.column(4).to_numpy()], [np.zeros(n, np.int32)]
            groups: dict = {}
            for i, key in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).value_lengths().to_pylist())):
                groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                if key in flat:
                    low, c = flat[key]
                    d = distances(unit(matrix(batch.column(3).take(pa.array(at)), key[1])), c)
                    ball = np.array([radius.get(low + i, -np.inf) for i in range(len(c))])
                    later = np.arange(len(c))[None, :] > (to[0][at] - low)[:, None]
                    x, y = np.nonzero((d <= ball[None, :] + reach + 1e-9) & later)
                    take.append(np.array(at)[x])
                    to.append((low + y).astype(np.int32))
                    side.append(np.ones(len(x), np.int32))
            index = pa.array(np.concatenate(take))
            cols = [c.take(index) for c in batch.columns[:4]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate(to)), pa.array(np.concatenate(side))],
                                             ["row", "copies", "label", "vec", "cell", "side"])

    met = scratch.cut(placed.mapInArrow(visit, "row long, copies long, label string, vec array<double>, cell int, side int")
                      .withColumn("size", F.size("vec")))
    group = ["label", "size", "cell"]
    cut = scratch.cut(met.groupBy(*group).agg(
        F.ceil(F.sum(F.when(F.col("side") == 0, 1).otherwise(0)) / MEMBERS).cast("int").alias("c"),
        F.ceil(F.sum("side") / VISITORS).cast("int").alias("v")))
    mine = F.pmod(F.xxhash64("row"), F.when(F.col("side") == 0, F.col("c")).otherwise(F.col("v"))).cast("int")
    until = lambda n: F.sequence(F.lit(0), n - 1)
    # Tasks: (0, i, j) for chunks i <= j of a cell, (1, i, v) for a chunk and visitors; side 0 owns the tree.
    pairs = F.transform(until(F.col("c")), lambda j: F.struct(
        F.lit(0).alias("kind"), F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j"),
        (F.col("mine") > j).cast("int").alias("s")))
    hosts = F.when(F.col("v") > 0, F.transform(until(F.greatest(F.col("v"), F.lit(1))), lambda v: F.struct(
        F.lit(1).alias("kind"), F.col("mine").alias("i"), v.alias("j"), F.lit(0).alias("s")))).otherwise(F.slice(pairs, 1, 0))
    guests = F.transform(until(F.greatest(F.col("c"), F.lit(1))), lambda i: F.struct(
        F.lit(1).alias("kind"), i.alias("i"), F.col("mine").alias("j"), F.lit(1).alias("s")))
    tasks = met.join(cut, group).withColumn("mine", mine).select(
        "row", "copies", "vec", *group, F.explode(F.when(F.col("side") == 1, guests).otherwise(F.concat(pairs, hosts))).alias("t")).select(
        *group, "t.kind", "t.i", "t.j", "t.s", "row", "copies", "vec")

    def compare(key: tuple[pa.Scalar, ...], data: pa.Table) -> pa.Table:
        size, kind, i, j = key[1].as_py(), key[3].as_py(), key[4].as_py(), key[5].as_py()
        side = data["s"].to_numpy()
        order = np.argsort(side, kind="stable")
        row, copies = data["row"].to_numpy()[order], data["copies"].to_numpy()[order]
        x = unit(matrix(data["vec"].combine_chunks(), size)[order])
        n = int((side == 0).sum())
        links, roots = _compare(x[:n], copies[:n], x[n:], copies[n:], cosine, kind == 0 and i == j)
        some = links > 0
        return pa.table({"row": row[some], "links": links[some], "root": row[roots[some]]})

    found = scratch.cut(tasks.groupBy(*group, "kind", "i", "j").applyInArrow(compare, "row long, links long, root long"))
    roots = components(spark, found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("row").agg(F.sum("links").alias("links"))
    known = scratch.cut(distinct.join(counts, "row", "left").join(roots.withColumnRenamed("node", "row"), "row", "left").select(
        "label", "vec", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "row").alias("root")))
    least = scratch.cut(known.groupBy("root").agg(F.min("first").alias("component")))
    named = scratch.cut(known.join(least, "root").select("label", "vec", "n_links", "component"))
    scratch.free(placed, met, cut, found, known, least, distinct)
    out = good.join(named, ["label", "vec"]).select("vec_id", "n_links", "component").unionByName(
        rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component")))
    return out.select("vec_id", "n_links", F.col("component").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"))
