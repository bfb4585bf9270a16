"""Counted lists, multisets and class keys of a group's names.

Names are counted per group before anything is collected, so a list is as long
as the vocabulary of names and not as long as the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_counts(df: DataFrame, keys: Sequence[str], name: str, count: Column | None = None) -> DataFrame:
    """Summed count per (group, name)."""
    total = F.count(F.lit(1)) if count is None else F.sum(count)
    return df.filter(F.col(name).isNotNull()).groupBy(*keys, name).agg(total.alias("count"))


def named_items(df: DataFrame, keys: Sequence[str], name: str, count: Column | None = None) -> DataFrame:
    """Items as an array of (name, count) sorted by name; groups without a name fall out."""
    pairs = F.struct(F.col(name).alias("name"), F.col("count"))
    return name_counts(df, keys, name, count).groupBy(*keys).agg(
        F.array_sort(F.collect_list(pairs)).alias("items")
    )


def class_key(items: Column) -> Column:
    """Sorted distinct names of an item array."""
    return F.array_sort(F.array_distinct(F.transform(items, lambda i: i["name"])))


def multiset_label(items: Column) -> Column:
    """``NamexN, Name``: the count is written only above one."""
    return F.concat_ws(", ", F.transform(items, lambda i: F.when(
        i["count"] > 1, F.concat(i["name"], F.lit("x"), i["count"].cast("string"))).otherwise(i["name"])))


def item_total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda total, i: total + i["count"])


def first_seen_counts(df: DataFrame, keys: Sequence[str], name: str, order: str) -> DataFrame:
    """Distinct names in order of first appearance: array of (first, name, n)."""
    per_name = df.groupBy(*keys, name).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    entry = F.struct("first", F.col(name).alias("name"), "n")
    return per_name.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def counted_text(entries: Column) -> Column:
    """One line per name: ``A x N``, or ``A`` alone."""
    return F.concat_ws("\n", F.transform(entries, lambda e: F.when(
        e["n"] > 1, F.concat(e["name"], F.lit(" x "), e["n"].cast("string"))).otherwise(e["name"])))


def pending_text(entries: Column, limit: int | None = None) -> Column:
    """Pending lines with issue counts; the first ``limit`` of them, if given."""
    def line(e):
        n = e["n"].cast("string")
        many = F.concat(F.lit("  - "), e["name"], F.lit(" x"), n, F.lit(" (0/"), n, F.lit(" issued) [PENDING]"))
        return F.when(e["n"] > 1, many).otherwise(F.concat(F.lit("  - "), e["name"], F.lit(" [PENDING]")))

    shown = entries if limit is None else F.slice(entries, 1, limit)
    return F.concat_ws("\n", F.transform(shown, line))


def multiset_equal(left: Column, right: Column) -> Column:
    return F.array_sort(left) == F.array_sort(right)
