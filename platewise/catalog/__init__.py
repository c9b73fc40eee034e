"""Queries over the driver tables: thin stand-ins around the library's operators, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if it can be said in SQL, the statement that must give the same rows."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    from platewise.catalog import accounting, files, reads, summary, taxonomy  # noqa: F401
