"""Projections and predicates over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def priority_coalesce(*ids: Column) -> Column:
    """The first id that is known, in order of priority."""
    return F.coalesce(*ids)


def table_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the columns that the target table has, in its order."""
    return df.select(*[c for c in columns if c in df.columns])


def year_total_direction(df: DataFrame, year: int, total: int = 3) -> DataFrame:
    """Rows of the year and of the total of both directions with a known tmja."""
    return df.where((F.col("annee") == year) & (F.col("sens") == total) & F.col("tmja").isNotNull())


def valid_hourly_rows(df: DataFrame, hours: Sequence[str]) -> DataFrame:
    """Drops days whose hours are all 0 or null."""
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(h), F.lit(0)) != 0 for h in hours]))


def direction_kind(df: DataFrame, key: str, code: str) -> DataFrame:
    """Three direction codes or more mean both directions are counted."""
    return df.groupBy(key).agg(F.when(F.countDistinct(code) >= 3, "double sens").otherwise("sens unique").alias("sens_cpt"))
