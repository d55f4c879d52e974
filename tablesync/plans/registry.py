"""

Every query reads the given tables (whole), or data Spark derives from them. Queries whose
result cannot be written as plain SQL have no oracle entry and are checked by tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if it has one) to the registry."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from . import q_changes, q_nested, q_convert, q_retention, q_io, q_control, q_stream, q_stores  # noqa: F401
