"""Registry of the llm queries; ``load`` imports the modules that fill it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query; ``sql`` is its DuckDB twin (None: tested by brute force)."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def load() -> None:
    from lookout.llm import queries  # noqa: F401
