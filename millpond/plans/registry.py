"""Query registry: a Spark callable per key and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millpond.plans.fixtures_sql import FIXTURES, NEEDS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; an ``oracle`` is SQL with the same columns and rows."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return register


def sql(body: str, *fixtures: str, **ctes: str) -> str:
    """SQL text with the named retail tables, then further CTEs, in front of it."""
    names: list[str] = []
    for f in fixtures:
        for n in (*NEEDS.get(f"fx_{f}", []), f"fx_{f}"):
            if n not in names:
                names.append(n)
    parts = [f"{n} AS ({FIXTURES[n]})" for n in names]
    parts += [f"{n} AS ({text})" for n, text in ctes.items()]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + body
