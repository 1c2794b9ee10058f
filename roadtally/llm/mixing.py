"""Mixing sources to target weights by a time-varying curriculum, in DataFrame operations only.

Time runs from 0 to 1 over the training run.  A source's weight follows the
schedule ``target * (1 + slope * (2t - 1))``, whose integral over the run is
its target; slopes run evenly from ``-STEEPNESS`` for the first source (early)
to ``+STEEPNESS`` for the last (late).  Integrated, the source has demanded
``target * (t + slope * (t*t - t))`` words by time t.  A copy of a document
that stands at word x of its source's stream is read when that demand reaches
x: the quadratic is inverted in closed form, and rows are range-sorted by it.

A source's stream is its documents in hash order, over and over until the
target is met: ``floor(target / source_size)`` whole passes, and a last pass
of the documents that fit in it, up to the target.  What is still missing is
filled in rounds by the documents left that fit it, again in hash order, until
none fits.  One more document may then end the source above its target, where
that comes nearer.  Running totals are made in two steps, over hash buckets and then
inside a bucket, so a source with a third of all rows spreads over many tasks.

Defined results: null text has size 0; the null source is a source, the last;
documents of size 0 are taken as often as their place says, which adds no
words; equal rows are told apart by their hash order and count; a source
without words has target 0; an empty table gives an empty result; extra
columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_or_empty, word_count

#: Buckets of a source in hash order: at least so many, and more where one would hold more rows than that on average.
BUCKETS, BUCKET_ROWS = 256, 100_000
STEEPNESS = 0.8
MOST = 3
#: Tells apart the rows of size above 0.
KEY = ["source", "h", "bucket", "middle"]


def targets(sizes: list[tuple[str | None, int]], most: int = MOST) -> list[tuple[str | None, int, float]]:
    """(source, size, target): weights 1, 2, 3 in turn, capped at ``most`` sizes, the excess reshared."""
    sizes = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = [1 + k % 3 for k in range(len(sizes))]
    found: dict[int, float] = {}
    left = float(sum(n for _, n in sizes))
    while len(found) < len(sizes):
        free = [k for k in range(len(sizes)) if k not in found]
        each = left / sum(weight[k] for k in free)
        over = [k for k in free if each * weight[k] > most * sizes[k][1]]
        for k in over or free:
            found[k] = float(most * sizes[k][1]) if over else each * weight[k]
        left -= sum(found[k] for k in over)
    return [(s, n, found[k]) for k, (s, n) in enumerate(sizes)]


def position(x: Column, target: Column, slope: Column) -> Column:
    """The time t in [0, 1] at which target * (t + slope * (t*t - t)) reaches x."""
    share = x / target
    b = 1 - slope
    root = F.sqrt(F.greatest(b * b + 4 * slope * share, F.lit(0.0)))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * share / (b + root)))


def _row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _running(rows: DataFrame, of: str, out_col: str) -> DataFrame:
    """``rows`` with the running total of ``of`` in each source, in hash order."""
    upto = Window.partitionBy("b_source").orderBy("b_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = rows.groupBy(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket")).agg(F.sum(of).alias("n"))
    buckets = buckets.select("b_source", "b_bucket", (F.sum("n").over(upto) - F.col("n")).alias("b_before"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    return joined.withColumn(out_col, F.col("b_before") + F.sum(of).over(inside)).drop("b_source", "b_bucket", "b_before")


def _fill(rows: DataFrame) -> DataFrame:
    """The rows (KEY) outside the last pass that fill what it leaves of each source's target."""
    gaps = {r["source"]: r["gap"] for r in rows.groupBy("source").agg((F.first("rest") - F.sum(F.when(F.col("last"), F.col("size")).otherwise(0))).alias("gap")).collect()}

    def with_gap(left: DataFrame) -> DataFrame:
        table = rows.sparkSession.createDataFrame(list(gaps.items()), "g_source string, gap double")  # as many rows as there are sources
        return left.join(table, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")

    unused = rows.where((F.col("passes") < MOST) & ~F.col("last") & (F.col("size") > 0)).select(*KEY, "doc_id", "size")
    left, picked = unused, rows.where("false").select(*KEY)
    while True:
        fits = with_gap(left).where("size <= gap")
        tried = materialise(_running(fits, "size", "end").select(*KEY, "doc_id", "size", (F.col("end") <= F.col("gap")).alias("now")), "mix-round")
        took = tried.where("now").groupBy("source").agg(F.sum("size").alias("n")).collect()
        if not took:
            break
        # gaps only shrink: what doesn't fit now never will
        picked, left = picked.union(tried.where("now").select(*KEY)), tried.where("not now")
        gaps |= {r["source"]: gaps[r["source"]] - r["n"] for r in took}
    # one document more, of those that no round has picked
    same = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("h") == F.col("p_h")) & (F.col("bucket") == F.col("p_bucket")) & (F.col("middle") == F.col("p_middle"))
    free = unused.join(picked.select([F.col(c).alias(f"p_{c}") for c in KEY]), same, "left_anti")
    over = with_gap(free).where("size > gap and size < 2 * gap")
    return picked.union(over.groupBy("source").agg(F.min(F.struct("size", "h", "bucket", "middle")).alias("f")).select("source", "f.h", "f.bucket", "f.middle"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", steepness: float = STEEPNESS) -> DataFrame:
    """One row per input row, range-sorted by its first training position.

    doc_id, source, h (hash of id and text), size, source_size, target, copies, taken, positions (one for each copy).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_or_empty(text_col)).cast("long").alias("size"), _row_hash(id_col, text_col).alias("h"))
    rows = materialise(rows, "mix-rows")
    # code points sort as UTF-8 bytes do; as many rows as there are sources
    each = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sizes = [(r["source"], r["size"]) for r in each]
    buckets = max(BUCKETS, int(max((r["n"] for r in each), default=0) / BUCKET_ROWS) + 1)
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    plan = [(s, n, t, (2 * k / (len(sizes) - 1) - 1) * steepness if len(sizes) > 1 else 0.0) for k, (s, n, t) in enumerate(targets(sizes))]
    plan_table = spark.createDataFrame(plan, "source string, source_size long, target double, slope double")
    rows = rows.join(plan_table.withColumnRenamed("source", "p_source"), F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    passes = F.when(F.col("source_size") == 0, 1).otherwise(F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))).cast("int")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    # a document larger than all of the last pass isn't read there
    rows = rows.withColumn("passes", passes).withColumn("rest", rest).withColumn("fit", F.when(F.col("size") <= F.col("rest"), F.col("size")).otherwise(0))
    rows = _running(_running(rows, "size", "before"), "fit", "end")
    last = (F.col("source_size") > 0) & (F.col("size") <= F.col("rest")) & (F.col("end") <= F.col("rest"))
    rows = materialise(rows.withColumns({"middle": F.col("before") - F.col("size") / 2, "last": last}), "mix-placed")
    picked = _fill(rows)
    same = F.col("source").eqNullSafe(F.col("f_source")) & (F.col("h") == F.col("f_h")) & (F.col("bucket") == F.col("f_bucket")) & (F.col("middle") == F.col("f_middle")) & (F.col("size") > 0)
    rows = rows.join(picked.select([F.col(c).alias(f"f_{c}") for c in KEY]), same, "left")
    again = F.col("last") | F.col("f_h").isNotNull()
    rows = rows.withColumns({"copies": F.col("passes") + again.cast("int"), "again": F.when(again, F.col("size")).otherwise(0)}).drop(*[f"f_{c}" for c in KEY])
    # the last pass reads those that it takes, one after the other
    rows = _running(rows, "again", "upto")
    late = F.col("passes") * F.col("source_size") + F.col("upto") - F.col("size") / 2
    x = lambda k: F.least(F.col("target"), F.when(k < F.col("passes"), F.col("middle") + k * F.col("source_size")).otherwise(late))
    when = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda k: F.when(F.col("target") > 0, position(x(k), F.col("target"), F.col("slope"))).otherwise(0.0))
    rows = rows.withColumn("positions", F.when(F.col("copies") > 0, when).otherwise(F.array().cast("array<double>")))
    rows = rows.select("doc_id", "source", "h", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "positions", F.get("positions", F.lit(0)).alias("first_position"))
    # whole rows in the key, so that equal positions don't meet in one task
    return rows.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents, one row for each copy, in training order; the columns are those of ``docs``."""
    mixed = mix(docs, id_col, text_col, source_col).where("copies > 0")
    # equal rows share a plan: which of them a copy is made of makes no difference
    plan = mixed.groupBy("doc_id", "source", "h").agg(F.flatten(F.collect_list("positions")).alias("__position"))
    plan = plan.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("h").alias("__plan"), "__position")
    keyed = docs.withColumn("__h", _row_hash(id_col, text_col)).dropDuplicates([id_col, source_col, "__h"])
    joined = keyed.join(plan, keyed[id_col].eqNullSafe(plan["__id"]) & keyed[source_col].eqNullSafe(plan["__source"]) & (keyed["__h"] == plan["__plan"]))
    copies = joined.withColumn("__position", F.explode("__position"))
    return copies.repartitionByRange("__position", id_col).sortWithinPartitions("__position", id_col).select(*[F.col(c) for c in docs.columns])
