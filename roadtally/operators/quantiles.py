"""Exact quantiles of groups of any size, by counted values.

``percentile`` keeps the distinct values of a group in one task.  Here the
(group, value) pairs are counted, which combines before the shuffle, and the
counts are dealt by range of group and value, so that a large group fills many
ranges.  The sizes of the ranges of a group are added up, a row each; inside a
range, running totals tell which positions of the sorted group a value covers.
The values at the two positions around each quantile are picked and interpolated.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """One row a group with a column for each of ``shares`` (name -> share), linearly interpolated.

    Null values don't count; a group without other values has nulls; null group
    columns are groups of their own.
    """
    keys = [f"k{n}" for n in range(len(group))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(group, keys)], F.col(value).cast("double").alias("v"))
    counts = rows.groupBy(*keys, "v").agg(F.count("*").alias("c"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("k"))
    dealt = materialise(counts.select(g.alias("g"), "v", "c").repartitionByRange(ranges, "g", "v").withColumn("r", F.spark_partition_id()), "counts")
    known = dealt.where("v is not null").withColumn("h", F.xxhash64(F.to_json(F.struct("g"), {"ignoreNullFields": "false"})))
    sizes = known.groupBy("g", "h", "r").agg(F.sum("c").alias("n"))
    w = Window.partitionBy("g", "h").orderBy("r")
    sizes = sizes.select("g", "h", "r", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("g", "h")).alias("whole"))
    inside = Window.partitionBy("g", "h", "r").orderBy("v")
    o = sizes.select(F.col("g").alias("og"), F.col("h").alias("oh"), F.col("r").alias("o_r"), "before", "whole")
    # groups are compared null-safely; the hash beside them is what the join deals by
    j = known.withColumn("upto", F.sum("c").over(inside)).join(o, (F.col("h") == F.col("oh")) & (F.col("r") == F.col("o_r")) & F.col("g").eqNullSafe(F.col("og")))
    j = j.withColumn("last", F.col("before") + F.col("upto") - 1).withColumn("first", F.col("last") - F.col("c") + 1)
    covers = lambda p: F.max(F.when((F.col("first") <= p) & (p <= F.col("last")), F.col("v")))
    picks = []
    for n, share in enumerate(shares.values()):
        at = F.lit(float(share)) * (F.col("whole") - 1)
        picks += [covers(F.floor(at)).alias(f"lo{n}"), covers(F.ceil(at)).alias(f"hi{n}"), F.max(at - F.floor(at)).alias(f"t{n}")]
    found = j.groupBy("g", "h").agg(*picks)
    all_groups = dealt.select("g").distinct().join(found.withColumnRenamed("g", "fg"), F.col("g").eqNullSafe(F.col("fg")), "left")
    out = [F.col(f"g.{k}").alias(c) for c, k in zip(group, keys)]
    out += [(F.col(f"lo{n}") + F.col(f"t{n}") * (F.col(f"hi{n}") - F.col(f"lo{n}"))).alias(name) for n, name in enumerate(shares)]
    return all_groups.select(*out)
