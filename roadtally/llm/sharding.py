"""Sharding by sampled splitters.

The key of a row is the hash of its text, then its id, so rows of equal text
are neighbours.  A size-weighted sample of keys gives quantile boundaries;
rows are range-partitioned by them, and ranges that turn out overfull are
sampled and cut again, until none is that has more than one key.  Running totals over the ranges then give every row its
place in the whole order, and the shard is the twenty-fourth (or whichever) of
all bytes that the row's middle falls in: law ``bytes``.

Equal texts stay together where they fit: a group is placed by its first row
unless it is larger than a hundredth of a shard or than a range.

What the driver holds: one total a range, of which there are ``RANGES_PER_SHARD``
a shard or one for ``ROWS_PER_RANGE`` rows, and ``SAMPLE_PER_RANGE`` keys for
each on average (``SAMPLE`` at least).

Defined results: null text has size 8 and crc32 0; a null id sorts before
others of its text; repeated rows each get their own slot; an empty table gives
an empty result; a single row larger than a shard fills it alone; extra columns
are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SAMPLE, SAMPLE_PER_RANGE = 8_192, 16
RANGES_PER_SHARD, ROWS_PER_RANGE = 8, 4_000_000
OVERFULL = 2.0


def _hex(c: Column) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        _hex(F.xxhash64(F.coalesce(text, F.lit("")))).alias("text_key"),
        F.coalesce(_hex(F.col(id_col).cast("long")), F.lit("")).alias("id_key"),
    ).withColumn("key", F.concat("text_key", "id_key"))


def _quantiles(sample: list[tuple[str, float]], cuts: int) -> list[str]:
    """Splitters at equal steps of weight, ``cuts`` - 1 at most, cut to the text's hash where one step has one cut of it; a key over several steps gets one behind it too."""
    if not sample:
        return []
    sample = sorted(sample)
    weight = np.cumsum([w for _, w in sample])
    at = np.searchsorted(weight, weight[-1] * np.arange(1, cuts) / cuts)
    picked = [sample[min(i, len(sample) - 1)][0] for i in at]
    keys = sorted({*picked, *(k + " " for k, m in zip(picked, picked[1:]) if k == m)})
    heavy = {k[:16] for k, m in zip(keys, keys[1:]) if k[:16] == m[:16]}
    return sorted({k if k[:16] in heavy else k[:16] for k in keys})


def _draw(rows: DataFrame, total: float, size: int, seed: int) -> list[tuple[str, float]]:
    """About ``size`` keys, each row with a chance in proportion to its size; larger rows weigh more."""
    step = max(total / size, 1.0)
    chance = F.least(F.lit(1.0), F.col("size") / step)
    u = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return [(r["key"], max(r["size"], step)) for r in rows.where(u < chance).select("key", "size").collect()]


def assign_ranges(rows: DataFrame, splitters: list[str]) -> DataFrame:
    edges = np.array(splitters, dtype="U33")

    @F.pandas_udf("int")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(np.searchsorted(edges, keys.to_numpy(dtype="U33"), side="right").astype("int32"))

    return rows.withColumn("range", find("key")) if splitters else rows.withColumn("range", F.lit(0))


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = materialise(sized(docs, id_col, text_col), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = max(shards * RANGES_PER_SHARD, rows.count() // ROWS_PER_RANGE)
    sample = max(SAMPLE, SAMPLE_PER_RANGE * ranges)
    splitters, seed = _quantiles(_draw(rows, total, sample, 1), ranges), 1
    while True:  # cut overfull ranges again, by a sample of their own rows
        placed = assign_ranges(rows, splitters)
        totals = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("most"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("range").collect()
        # what one row weighs can't be cut
        over = {r["range"]: r for r in totals if r["bytes"] - r["most"] > OVERFULL * total / ranges and r["lo"] < r["hi"]}
        if not over:
            break
        seed += 1
        drawn = _draw(placed.where(F.col("range").isin(list(over))), sum(r["bytes"] for r in over.values()), sample, seed)
        edges = np.array(splitters)
        more = set(splitters)
        for k, r in over.items():
            own = [s for s in drawn if np.searchsorted(edges, s[0], side="right") == k]
            more |= {s for s in _quantiles(own, int(r["bytes"] * ranges / total) + 1) if r["lo"] < s <= r["hi"]}
        splitters = sorted(more)
    before, offsets = (0, 0), []
    for r in totals:
        offsets.append((r["range"], *before))
        before = (before[0] + r["bytes"], before[1] + r["n"])
    table = docs.sparkSession.createDataFrame(offsets, "range int, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy("key", "size")
    group = Window.partitionBy("range", "text_key")
    placed = placed.join(table, "range").select(
        "doc_id", "size", "text_crc32", "range", "text_key", "key",
        (F.col("bytes_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.row_number().over(order) - 1).alias("place"),
    )
    own = F.col("start") + F.col("size") / 2
    together = F.min("start").over(group) + F.sum("size").over(group) / 2
    middle = F.when(F.sum("size").over(group) <= total / shards / 100, together).otherwise(own)
    number = F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int")
    placed = materialise(placed.select("doc_id", "size", "text_crc32", "place", number.alias("shard")), "shard-placed")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row a shard
    return placed.join(firsts, "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
