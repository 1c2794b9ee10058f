"""Window functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows equal to their group's maximum; ties stay.  An aggregation and a semi-join, so no group is held whole."""
    return df.join(df.groupBy(*keys).agg(F.max(value).alias(value)), [*keys, value], "left_semi")


def rank_in_reference(df: DataFrame, stored: DataFrame, ref: str, *order: Column) -> DataFrame:
    """Sequence number in a reference, going on from the largest stored rank."""
    most = stored.groupBy(ref).agg(F.max("rang").alias("__most"))
    n = F.row_number().over(Window.partitionBy(ref).orderBy(*order))
    return df.join(most, ref, "left").withColumn("rang", n + F.coalesce("__most", F.lit(0))).drop("__most")


def count_partition(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)))


def fill_forward(df: DataFrame, keys: Sequence[str], order: str, *cols: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def fill_back(df: DataFrame, keys: Sequence[str], order: str, *cols: str) -> DataFrame:
    """Runs through the rows from the last to the first: a frame that ends with the group would be gone through again for every row."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def day_rollover(df: DataFrame, keys: Sequence[str], order: str, day: str) -> DataFrame:
    """Months passed since the first row: a day of month that falls back starts a new month."""
    w = Window.partitionBy(*keys).orderBy(order)
    fell = (F.col(day) < F.lag(day).over(w)).cast("int")
    return df.withColumn("__fell", F.coalesce(fell, F.lit(0))).withColumn("mois_ecoules", F.sum("__fell").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__fell")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows with a ``doublon`` column: whether the key occurs more than once."""
    return df.withColumn("doublon", F.count("*").over(Window.partitionBy(*keys)) > 1)


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row of each key: the first in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
