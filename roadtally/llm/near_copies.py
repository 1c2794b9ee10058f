"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more link.

Candidates come out of SimHash fingerprints: majority bits of the hashed shingles,
256 of them or more, each of which two texts at 0.8 share with a chance of
``AGREE`` (unrelated ones: one half).  ``shape`` tables deal the fingerprints to
buckets of some ``BUCKET`` texts, each table by bits of its own; there are so many
tables that two texts at 0.8 miss each other in all with a chance of ``MISS``.
More texts need longer bucket numbers and more tables, so rows grow with the power
1.24 of the texts.  A bucket is searched by the Gray index of ``simhash`` over 64
bits (``DISTANCE``: 0.8 is expected at 10, unrelated texts at 32) and then by 256
bits (``APART``: 0.8 is expected at 39, more than 62 with a chance of about 1 in
10,000; unrelated texts at 128).  It returns the clusters of what links there, so
that texts without a candidate go at once; all candidates are compared by their
whole sets of 64-bit shingle hashes.  A crowded bucket, most of which is around
one text (``AROUND``), is one cluster of those, and only the others are compared.

Members of a cluster are first compared with two of them, which differ from cluster
to cluster; that settles large groups of copies in one linear step.  In clusters
whose members are then still in several components, those outside the cluster's
largest component are compared with the members of other components; pairs inside
a component are never made.

A large group whose members differ from one text, each in its own way, has many
pairs just below the limit.  They are told apart exactly: of the texts that are
still open, shingles that at most ``RARE`` of them have are rare.  Two texts share
no more than the smaller of their numbers of other shingles, plus the rare ones
that both have; the latter are counted pair by pair, ``(RARE - 1) / 2`` rows a
shingle at most.  A text whose own other shingles can't reach the limit with the
smallest text of its cluster meets no partner there.

Defined results: words are compared in lower case; a text of up to five words is
one shingle; texts of no word link; equal texts link; a null id comes after all
others; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, materialise
from .components import components
from .simhash import SEED, GrayIndex, forest, gray_rank, keep_first, shingle_hashes

SHINGLE, DISTANCE, APART, AROUND, RARE = 5, 24, 62, 88, 4
BUCKET, CROWD, MISS = 2048, 8192, 1e-4
#: At a similarity of 0.8, sets of one size have a cosine of 8/9.
AGREE = 1 - math.acos(8 / 9) / math.pi
#: Words of 64 bits that are compared, and at most worked out.
WIDE, MOST = 4, 40
_DRAW = np.random.default_rng(SEED)
FLIP = _DRAW.integers(0, 2**64, (MOST, 1), np.uint64)
TIMES = _DRAW.integers(0, 2**64, (MOST, 1), np.uint64) | np.uint64(1)
EIGHTH = np.uint64(0x0101010101010101)


def shape(texts: int) -> tuple[int, int]:
    """Bits of a bucket's number, and tables."""
    bits = min(16, max(0, math.ceil(math.log2(max(1, texts) / BUCKET))))
    return bits, math.ceil(math.log(MISS) / math.log(1 - AGREE**bits)) if bits else 1


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    found = [np.unique(h) for h in shingle_hashes(text, SHINGLE)]
    return np.unique(np.concatenate(found)) if found else np.array([xxhash.xxh64_intdigest(b"", SEED)], np.uint64)


def majorities(hashes: np.ndarray, words: int) -> np.ndarray:
    """64 bits for each of ``words`` SimHash fingerprints of the hashes, mixed anew for each: the bits that more than half have."""
    ones = np.zeros((words, 8, 8), np.int64)
    for at in range(0, len(hashes), 4080):
        x = (hashes[at : at + 4080] ^ FLIP[:words]) * TIMES[:words]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        cuts = np.arange(0, x.shape[1], 255)  # a byte counts that far
        for k in range(8):
            ones[:, k] += np.add.reduceat(x >> np.uint64(k) & EIGHTH, cuts, axis=1).view(np.uint8).reshape(words, -1, 8).sum(axis=1, dtype=np.int64)
    return (ones * 2 > len(hashes)).reshape(-1)


def signature(bits: int, tables: int) -> Column:
    """f: the words that are compared; keys: the text's bucket in each table."""

    @F.pandas_udf(T.StructType([T.StructField("f", T.ArrayType(T.LongType())), T.StructField("keys", T.ArrayType(T.LongType()))]))
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = max(WIDE, -(-bits * tables // 64))
        place, first = 1 << np.arange(bits, dtype=np.int64), np.arange(tables, dtype=np.int64) << bits
        for texts in batches:
            found = [majorities(shingles(t), words) for t in texts]
            f = [np.packbits(m[: WIDE * 64]).view("<i8") for m in found]
            yield pd.DataFrame({"f": f, "keys": [first + m[: bits * tables].reshape(tables, bits) @ place for m in found]})

    return compute("text")


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _links(f: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of places, enough to connect all fingerprints that are near each other; ``f`` is in Gray order of its first word."""
    n = len(f)
    if n > CROWD:
        tried = [_differ(f, f[at]) <= AROUND for at in range(0, n, n // 8)]
        around = max(tried, key=np.count_nonzero)
        rest = np.flatnonzero(~around)
        if len(rest) * 2 < n:
            most = np.flatnonzero(around)
            yield most, np.full(len(most), most[0])
            for at in rest:
                near = np.flatnonzero(_differ(f, f[at]) <= APART)
                yield near, np.full(len(near), at)
            return
    for a, b in GrayIndex(f[:, 0]).pairs(DISTANCE):
        near = _differ(f[a], f[b]) <= APART
        yield a[near], b[near]


def _search(part: pd.DataFrame) -> pd.DataFrame:
    """Clusters of a bucket: key, h; texts that are near no other are left out."""
    f = part[[f"f{k}" for k in range(WIDE)]].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(gray_rank(f[:, 0]), kind="stable")
    root, h = forest(len(f), _links(f[order])), part["h"].to_numpy(np.int64)[order]
    size = np.bincount(root, minlength=len(root))
    own = size[root] > 1
    return pd.DataFrame({"bucket": np.full(int(own.sum()), part["bucket"].iloc[0]) if len(part) else [], "root": root[own], "h": h[own]})


@F.pandas_udf(T.ArrayType(T.LongType()))
def _set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([shingles(t).view(np.int64) for t in texts])


def _near(a: str, b: str) -> Column:
    """Whether fingerprints are near each other, in the first 64 bits and in all."""
    differ = [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(WIDE)]
    return (differ[0] <= DISTANCE) & (sum(differ[1:], differ[0]) <= APART)


def _sets(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """The sets of the texts whose h is asked for: h, s."""
    return materialise(texts.join(asked.select("h").distinct(), "h", "left_semi").select("h", _set("text").alias("s")).dropDuplicates(["h"]), "near-sets")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    both = pairs.join(sets.select(F.col("h").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("h").alias("b"), F.col("s").alias("sb")), "b")
    return materialise(both.where(_reaches(F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"))).select("a", "b"), "near-links")


def _reaches(shared: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes ``a`` and ``b`` that share so many are similar: 4/5 of the union, in whole numbers."""
    return shared * 9 >= (a + b) * 4


def _pair(x: str, y: str) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _across(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may be similar.

    ``open_``: key, h, f, keys, component, main - the members of clusters that have several components.
    """
    gram = sets.select("h", F.explode("s").alias("gram"))
    held = materialise(gram.join(gram.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") <= RARE), "gram"), "near-rare")
    size = sets.select("h", F.size("s").alias("size"))
    of = size.join(held.groupBy("h").agg(F.count("*").alias("rare")), "h", "left").select("h", "size", (F.col("size") - F.coalesce("rare", F.lit(0))).alias("other"))
    of = materialise(of.join(open_.select("h", "component").distinct(), "h"), "near-sizes")
    # without a rare shingle in common
    able = open_.join(of.drop("component"), "h").where(F.col("other") * 5 >= F.col("size") * 4)
    floor = able.groupBy("key").agg(F.min("size").alias("floor"))
    able = able.join(floor, "key").where(_reaches(F.col("other"), F.col("size"), F.col("floor")))
    side = lambda s: [F.col(c).alias(f"{s}{n}") for c, n in (("h", ""), ("f", "_f"), ("component", "_in"), ("keys", "_keys"), ("size", "_size"), ("other", "_other"))]
    x, y = able.where("component <> main").select("key", *side("x")), able.select("key", (F.col("component") == F.col("main")).alias("y_main"), *side("y"))
    # every cluster that two such texts share would make the pair: only the first one does, and in one order
    once = (F.col("y_main") | F.expr("x < y")) & (F.array_min(F.array_intersect("x_keys", "y_keys")) == F.col("key"))
    enough = _reaches(F.least("x_other", "y_other"), F.col("x_size"), F.col("y_size"))
    apart = F.col("x_in") != F.col("y_in")
    plain = x.join(y, "key").where(apart & enough & _near("x_f", "y_f") & once).select(*_pair("x", "y"))
    # with some
    some = held.where("n > 1").select("gram", "h")
    both = some.withColumnRenamed("h", "x").join(some.withColumnRenamed("h", "y"), "gram").where("x > y").groupBy("x", "y").agg(F.count("*").alias("r"))
    both = both.join(of.select(*(F.col(c).alias(f"x{n}") for c, n in (("h", ""), ("component", "_in"), ("size", "_size"), ("other", "_other")))), "x")
    both = both.join(of.select(*(F.col(c).alias(f"y{n}") for c, n in (("h", ""), ("component", "_in"), ("size", "_size"), ("other", "_other")))), "y")
    both = both.where(apart & _reaches(F.least("x_other", "y_other") + F.col("r"), F.col("x_size"), F.col("y_size"))).select(*_pair("x", "y"))
    found = materialise(plain.union(both).distinct(), "near-across")
    forget(held)
    forget(of)
    return found


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, component."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    form = shape(texts.count())
    rows = materialise(texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "h", signature(*form).alias("g")).select("doc_id", "text_hash", "h", "g.f", "g.keys"), "near-rows")
    one = rows.dropDuplicates(["h"])
    dealt = one.select("h", *[F.get("f", F.lit(k)).alias(f"f{k}") for k in range(WIDE)], F.explode("keys").alias("bucket"))
    each = dealt.groupBy("bucket").applyInPandas(_search, "bucket long, root long, h long").select(F.xxhash64("bucket", "root").alias("key"), "h")
    each = materialise(each, "near-clusters")
    held = materialise(each.groupBy("h").agg(F.collect_list("key").alias("keys")).join(one.select("h", "f"), "h"), "near-held")
    each = each.join(held.select("h", "f"), "h")
    order = F.struct(F.xxhash64("h", "key").alias("o"), "h", "f")
    ends = each.groupBy("key").agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
    shared = materialise(each.join(ends, "key"), "near-shared")
    spokes = shared.select("h", "f", F.explode(F.array("lo", "hi")).alias("m")).select("h", "f", F.col("m.h").alias("m"), F.col("m.f").alias("m_f"))
    star = materialise(spokes.where((F.col("h") != F.col("m")) & _near("f", "m_f")).select(*_pair("h", "m")).distinct(), "near-star")
    sets = _sets(star.select(F.explode(F.array("a", "b")).alias("h")), texts)
    links = _similar(star, sets)
    forget(sets)
    member = materialise(components(links), "near-members").withColumnRenamed("node", "h")
    placed = shared.select("key", "h").join(member, "h", "left").withColumn("component", F.coalesce("component", "h"))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("n")).where("n > 1").drop("n")
    open_ = materialise(placed.join(mixed, "key").join(held, "h"), "near-open")
    forget(held)
    forget(shared)
    if not open_.isEmpty():
        sets = _sets(open_, texts)
        across = _across(open_, sets).join(star, ["a", "b"], "left_anti")
        links = links.union(_similar(across, sets))
        forget(sets)
        member = materialise(components(links), "near-members").withColumnRenamed("node", "h")
    forget(star)
    forget(open_)
    return rows.join(member, "h", "left").select("doc_id", "text_hash", F.coalesce("component", "h").alias("component"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id; of repeated rows one."""
    return keep_first(docs, near_components(docs, id_col, text_col), id_col, text_col)
