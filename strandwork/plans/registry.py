"""Where the modules of queries enter theirs: a query, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query beside the SQL of the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def plain(f):
    """Registers a query without SQL beside it; tests hold its algorithm against cases worked out by hand or by brute force, or grouped_sql.py has its SQL."""
    QUERIES[f.__name__] = f
    return f
