"""Fixpoints over tables: components of a graph and the closure of implications."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.session import cut_lineage


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """One node of each component per node: ``nodes(node)``, ``links(a, b)``.

    Each round lets every node point at its least neighbour, follows the
    pointers a few steps, and draws the links together onto the nodes pointed
    at. Linked nodes at least halve per round, so long chains take few rounds
    and later rounds are small. Rounds are written out; the pointers of all
    rounds are followed once at the end.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut_lineage(both.filter(F.col("a") != F.col("b")).distinct())
    rounds = []
    while not edges.isEmpty():
        hook = cut_lineage(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")))
        reps = hook.select("a", F.col("to").alias("rep"))
        for _ in range(3):
            reps = reps.join(hook.select(F.col("a").alias("rep"), "to"), "rep").select("a", F.col("to").alias("rep"))
        reps = cut_lineage(reps)
        of = lambda name: reps.select(F.col("a").alias(name), F.col("rep").alias(f"{name}2"))
        drawn = edges.join(of("a"), "a").join(of("b"), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        # A node pointed at may itself point on: it stays linked to where it points.
        onward = reps.select("rep").distinct().join(of("rep"), "rep").select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
        back = onward.select(F.col("b").alias("a"), F.col("a").alias("b"))
        edges = cut_lineage(drawn.unionByName(onward).unionByName(back).filter(F.col("a") != F.col("b")).distinct())
        rounds.append(reps)
    labels = nodes.select("node", F.col("node").alias("component"))
    for reps in rounds:
        labels = labels.join(reps.withColumnRenamed("a", "component"), "component", "left").select(
            "node", F.coalesce("rep", "component").alias("component"))
    return labels


def implied_pairs(pairs: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """All (entity, implied) pairs reachable from a list of fixed pairs, sorted."""
    known = set(pairs)
    grown = known
    while grown:
        grown = {(a, d) for a, b in grown for c, d in pairs if b == c} - known
        known = known | grown
    return sorted(known)


def implication_closure(pairs: DataFrame) -> DataFrame:
    """All (entity, implied) reachable pairs; the table is a small dimension.

    Stops when a round adds nothing, so mutual implications end too.
    """
    step = pairs.select("entity", "implied").distinct()
    known = cut_lineage(step)
    size = known.count()
    while True:
        longer = known.select("entity", F.col("implied").alias("_mid")).join(
            step.select(F.col("entity").alias("_mid"), "implied"), "_mid").select("entity", "implied")
        known = cut_lineage(known.unionByName(longer).distinct())
        grown = known.count()
        if grown == size:
            return known
        size = grown


def close_entities(rows: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """Entities per key together with everything they imply."""
    return held_with(rows, key, implication_closure(pairs))


def held_with(rows: DataFrame, key: str, closed: DataFrame) -> DataFrame:
    """Entities per key together with everything that a closed table says they imply."""
    held = rows.select(key, "entity").distinct()
    implied = held.join(closed, "entity").select(key, F.col("implied").alias("entity"))
    return held.unionByName(implied).distinct()
