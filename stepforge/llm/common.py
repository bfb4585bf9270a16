"""Shared pieces: tables in the shared folder, components of a graph, local unions."""

from __future__ import annotations

import os
import sys
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names made of these that no column of ``df`` has, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


#: Spark's setting to remove the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the shared folder; ``free`` removes those no later step reads.

    A later step reads finished files, so a lost executor costs a task and not
    the steps before it. For the same reason the shuffle files of a written table go at
    once; else they stay until the driver happens to collect its garbage, which
    does not come more often when they are larger.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def cut(self, *parts: DataFrame) -> DataFrame:
        """The rows of all ``parts``, which are written one after the other."""
        path = os.path.join(shared_folder(self.spark), f"cut-{uuid.uuid4().hex}")
        for df in parts:
            conf = df.sparkSession.conf
            before = conf.get(CLEANUP, None)
            conf.set(CLEANUP, "true")
            try:
                df.write.mode("append").parquet(path)
            finally:
                conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
        out = self.spark.read.schema(parts[0].schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def free(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for frame in frames:
            path = self.paths.pop(id(frame), None)
            if path is not None:
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(conf).delete(where, True)


def kept(owner: str) -> dict:
    """What the worker process keeps for ``owner`` over its tasks.

    What another operator kept goes: a worker lives on from stage to stage, and a
    vocabulary or a sketch that no task reads any more would stay in the executor's memory.
    """
    held = sys.modules.setdefault("_stepforge_kept", types.ModuleType("_stepforge_kept")).__dict__.setdefault("held", {})
    for other in [x for x in held if x != owner]:
        del held[other]
    return held.setdefault(owner, {})


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least node reachable.

    Alternates two star steps until no link changes: every node's larger
    neighbours are tied to its least neighbour, then its smaller ones. The
    least neighbours are written out before they are joined, so that the join
    has a plain exchange on both sides and a hub's rows can be split.
    """
    scratch = Scratch(spark)
    edges = scratch.cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    state = lambda f: f.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    known = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        large = scratch.cut(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        scratch.free(least)
        least = scratch.cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u")
        after = scratch.cut(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        scratch.free(large, least)
        scratch.free(edges)
        edges, before, known = after, known, state(after)
        if known == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def union(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of ``a[i]`` and ``b[i]``; every entry ends at the least index of its class."""
    while True:
        low = np.minimum(roots[a], roots[b])
        before = roots.copy()
        for at in (a, b, before[a], before[b]):
            np.minimum.at(roots, at, low)
        roots = roots[roots]
        if np.array_equal(roots, before):
            return roots


def as_bytes(column) -> list[bytes]:
    """Values of a binary Arrow column; null becomes empty."""
    return [b"" if x is None else x for x in column.to_pylist()]
