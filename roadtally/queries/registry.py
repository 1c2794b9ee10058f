"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..standins import VIEWS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: The texts as they were registered, for chains that end in the same step.
STEPS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``sql`` may use the views of ``standins``."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            STEPS[f.__name__] = sql.strip()
            SQL[f.__name__] = f"WITH {VIEWS_SQL}\nSELECT * FROM (\n{sql.strip()}\n)"
        return f

    return add
