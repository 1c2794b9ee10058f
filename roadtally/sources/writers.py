"""Sinks: append, update, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Adds rows to a table of Parquet files; whole files appear at once when the job commits."""
    w = df.write.mode("append")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def update(target: DataFrame, values: DataFrame, key: list[str], cols: list[str], only_when: Column | None = None) -> DataFrame:
    """The target with the columns of rows that have new values; ``only_when`` looks at the old row."""
    new = values.select(*key, *[F.col(c).alias(f"__new_{c}") for c in cols], F.lit(True).alias("__found"))
    hit = F.coalesce("__found", F.lit(False)) & (F.lit(True) if only_when is None else only_when)
    j = target.join(new, key, "left").withColumn("__hit", hit)
    j = j.withColumns({c: F.when(F.col("__hit"), F.coalesce(f"__new_{c}", c)).otherwise(F.col(c)) for c in cols})
    return j.select(*target.columns)


def export_addresses(df: DataFrame, path: str, address: str) -> None:
    """Rows whose address is no pair of coordinates yet, for geocoding elsewhere."""
    df.where(~F.col(address).rlike(r"^-?\d+\.?\d*;-?\d+\.?\d*$")).write.option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


