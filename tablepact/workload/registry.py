"""Registry of named queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import with_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` (with the CTEs it ``needs``) is its DuckDB equivalent."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(needs, sql)
        return fn

    return add
