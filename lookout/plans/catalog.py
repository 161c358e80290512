"""Query catalog: every registered operator as a Spark DataFrame builder
``(spark, sf_dir) -> DataFrame`` and, where SQL can express it, the DuckDB
oracle text over the same driver tables.

Each builder reads the driver tables (or tables Spark derives from them),
so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query; ``sql`` is its DuckDB oracle (None: rows-only check)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from lookout.plans import q_dataset, q_evaluation, q_images, q_streaming, q_tables, q_views  # noqa: F401
