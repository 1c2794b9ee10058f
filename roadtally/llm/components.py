"""Connected components of a link table, by rounds of star contraction.

Each round hangs every node and its neighbours on the smallest label it sees,
first from larger to smaller labels and then the other way; both are one
aggregation.  Rounds grow with the logarithm of the longest chain.  A node with
very many links only meets a ``min`` aggregation, which combines before the
shuffle, and the join after it is one that Spark can split.  The tables of a
round go when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges``: a, b (long).  Returns node, component (its smallest node) for every node with a link."""
    links = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(most_rounds):
        # large star: larger neighbours of u, and u itself, go to the smallest label around u
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).union(links.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialise(large.union(least.where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "links")
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("u"), F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        small = materialise(small, "links")
        same = links.count() == small.count() and links.exceptAll(small).isEmpty()
        forget(large)
        forget(links)
        links = small
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
