"""Queries over the driver tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stepforge.workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, using: str = ""):
    """Register a query; ``using`` names the SQL views its oracle reads."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = views.with_views(using.split(), sql)
        return function

    return add
