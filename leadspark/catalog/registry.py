"""Where queries register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadspark.sources.adapters import AS_OF, with_views  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL over the named views that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(views, sql)
        return run

    return register


def joined(column: str) -> Column:
    """An array column as comma-separated text, for comparison."""
    return F.array_join(column, ",").alias(column)


def ntz(column: str, alias: str | None = None) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(alias or column)


def holds(phrase: str, text: str = "lowered") -> str:
    """SQL: the lower-cased text holds the phrase free of neighbouring letters."""
    return f"regexp_matches({text}, '(^|[^\\p{{L}}]){phrase}($|[^\\p{{L}}])')"
