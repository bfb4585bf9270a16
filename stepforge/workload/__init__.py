"""Queries of every operator over the driver tables, with their SQL."""

from __future__ import annotations

import importlib

from stepforge.workload.registry import ORACLES, QUERIES

MODULES = ["aggregations", "graph_joins", "spatial", "battle", "timeline", "steps", "texts", "filters", "scans", "samples", "curation", "labels", "streams",
           "arithmetic"]


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"stepforge.workload.{module}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
