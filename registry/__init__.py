"""The queries the engine is checked and timed with, each next to its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under its function's name, with SQL giving the same rows."""

    def add(run: QueryFunction) -> QueryFunction:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(run, sql)
        return run

    return add


def load_all() -> dict[str, Query]:
    from registry import columns, dedup, intake, ordered, quality, reconcile, runs, scans, sinks, sql, streams  # noqa: F401

    return QUERIES
