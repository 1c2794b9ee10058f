"""Exact dedup: 128-bit content hash, bytes compared inside each group.

Two texts are equal when they are identical after deleting all white space.
Rows are grouped by the hash of that normalised text.  The same aggregation
carries the smallest and the largest normalised text of each hash; they differ
exactly when the hash collides, and only such hashes are grouped once more by
the text itself.  All of it is partial aggregation, so a group with a third of
all rows reaches the shuffle as one row per map task.

Defined results: null text = empty text; empty texts form one group; a null id
sorts after all others; of rows that tie in length and id exactly one stays;
an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, materialise, text_or_empty


def content_hash(norm: Column) -> Column:
    return F.unhex(F.md5(norm.cast("binary")))


def _normalised(text_col: str) -> Column:
    return F.regexp_replace(text_or_empty(text_col), SPACE_CLASS + "+", "")


def _best(n_chars: str = "n_chars") -> Column:
    """Order of preference: most code points, then a known id, then the smallest id."""
    return F.min(F.struct((-F.col(n_chars)).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    norm = _normalised(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.length(text_or_empty(text_col)).cast("long").alias("n_chars"), norm.alias("norm"))
    base = base.withColumn("h", hash_fn(F.col("norm")))
    narrow = base.select("doc_id", "n_chars", "h", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    rows = materialise(narrow.groupBy("doc_id", "n_chars", "h", "text_sha256").agg(F.count("*").alias("copies")), "exact-rows")
    size, best = F.sum("copies").alias("group_size"), _best().alias("best")
    same = base.groupBy("h").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).select("h", (F.col("lo") != F.col("hi")).alias("collides"))
    collisions = materialise(same.where("collides").select("h"), "exact-collisions")
    groups = materialise(rows.groupBy("h").agg(size, best), "exact-groups")  # so that Spark can split the join of a crowded hash
    if collisions.isEmpty():
        joined = rows.join(groups, "h")
    else:  # the hash took different texts for one: these groups go by their text
        sub = base.join(collisions, "h", "left_semi").groupBy("doc_id", "n_chars", "h", "norm").agg(F.count("*").alias("copies"), F.first(F.sha2(F.col("norm").cast("binary"), 256)).alias("text_sha256"))
        sub = materialise(sub, "exact-sub")
        own = sub.join(sub.groupBy("h", "norm").agg(size, best), ["h", "norm"]).drop("norm")
        joined = rows.join(collisions, "h", "left_anti").join(groups, "h").unionByName(own)
    stays = (F.col("n_chars") == -F.col("best.neg")) & F.col("doc_id").eqNullSafe(F.col("best.id"))
    # equal (id, text length) rows of one group can still be told apart by their count only
    return joined.select("doc_id", F.col("best.id").alias("keep_id"), "group_size", stays.alias("stays"), "text_sha256", "n_chars", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth")).select(
        "doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("nth") == 1)).alias("kept"), "text_sha256", "n_chars"
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = F.sha2(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.length(text_or_empty(text_col)), F.sha2(_normalised(text_col).cast("binary"), 256)), 256)
    kept = exact_classes(docs, id_col, text_col).where("kept")
    kept = kept.select(F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("n_chars"), F.col("text_sha256")), 256).alias("__exact_key"))
    return docs.withColumn("__exact_key", key).join(kept, "__exact_key", "left_semi").dropDuplicates(["__exact_key"]).drop("__exact_key")
