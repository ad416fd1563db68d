"""Queries over the given tables, one module per part of the operator inventory."""

from __future__ import annotations

import importlib

from millpond.plans.registry import ORACLE, QUERIES, Query

MODULES = (
    "rows",
    "joins",
    "aggregates",
    "scalars",
    "feeds",
    "gold_jobs",
    "silver_jobs",
    "io",
    "quality_rules",
    "streams",
    "model_jobs",
    "series_jobs",
)


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"millpond.plans.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
