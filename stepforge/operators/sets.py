"""Set operations on rows that are identified by a tag."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_by_tag(left: DataFrame, right: DataFrame, tag: str) -> DataFrame:
    """Left rows, then right rows whose tag the left does not have; right duplicates stay."""
    return left.unionByName(right.join(left.select(tag).distinct(), tag, "left_anti"))


def by_tag(rows: DataFrame, tags: DataFrame, tag: str) -> DataFrame:
    """Rows whose tag is listed; unknown tags are skipped."""
    return rows.join(tags.select(tag), tag, "left_semi")


def intersect_by_tag(left: DataFrame, right: DataFrame, tag: str) -> DataFrame:
    """Right rows whose tag the left has."""
    return by_tag(right, left, tag)


def except_by_tag(left: DataFrame, right: DataFrame, tag: str) -> DataFrame:
    """Left rows whose tag the right does not have."""
    return left.join(right.select(tag), tag, "left_anti")
