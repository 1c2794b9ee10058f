"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: majority bits of the XXH64 of all 3-word shingles.  Two link when
they differ in ``DISTANCE`` bits at most.

Distinct fingerprints are searched three times, each time rotated so that
another third of the bits stands on top: two that differ in two bits agree in
one of the thirds.  Rows are dealt to tasks by that third.  A task sorts its
fingerprints by Gray rank (neighbours in Gray order share long bit patterns),
folds runs of ``LEAF`` into nodes that keep the bits all members share (mask
and pattern), and runs of ``FAN`` nodes into upper nodes likewise.  Pairs of
nodes are followed downwards only while the differences accumulated on bits
shared by both stay within the distance, so whole groups drop out at once.  A
task returns a spanning forest of the links it finds, never all pairs.

A third of the bits that more than ``HOT`` distinct fingerprints share is split
by the same argument: their other bits are cut in three, and each fingerprint
goes to the three groups that also share one of the parts, so two that differ
in two bits still meet.  Groups that are crowded then are split on, until all
fit; with all bits shared a group is one fingerprint.  Every link comes out of
the Gray index of a group.

Defined results: null and empty texts, and texts of no word, have fingerprint
0; a text of one or two words is one shingle; equal fingerprints link; a null
id takes part in no component of others' smallest id, its component_id is the
smallest known id reachable, or null; repeated rows each get a row; an empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import components

DISTANCE, SHINGLE, SEED = 2, 3, 42
LEAF, FAN, HOT, SLICE = 32, 16, 200_000, 100_000
#: Bytes of text whose words are held at once.
PORTION = 1 << 20
#: First bit of each third, from the top; a rotation to the left by it puts that third on top.
ROTATIONS, TOP = (0, 22, 43), (22, 21, 21)
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, of some ``PORTION`` bytes of it at a time; nothing for a text of no word."""
    data = (text or "").encode().lower()
    digest, held, at, some = xxhash.xxh64_intdigest, [], 0, False
    while at < len(data):
        end = at + PORTION
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = held + data[at:end].split()
        at, held = end, words[max(0, len(words) - shingle + 1) :]
        if len(words) >= shingle:
            some = True
            yield np.array([digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)))], "<u8")
    if held and not some:
        yield np.array([digest(b" ".join(held), SEED)], "<u8")


def fingerprint(text: str | None) -> int:
    return majority(shingle_hashes(text, SHINGLE))


def majority(portions: Iterable[np.ndarray]) -> int:
    """The bits that more than half of the hashes have."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in portions:
        n += len(hashes)
        for at in range(0, len(hashes), 65536):
            ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint, as a signed long."""

    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out_col, compute(F.col(text_col)))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in the Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """Levels of nodes over values in Gray order; a node has the mask and the pattern its members share."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # from the leaves upwards
        lo, hi, run = self.values, self.values, LEAF
        while True:
            cuts = np.arange(0, len(lo), run)
            lo, hi = np.bitwise_and.reduceat(lo, cuts), np.bitwise_or.reduceat(hi, cuts)
            self.levels.append((~(lo ^ hi), lo))
            if len(lo) <= FAN:
                break
            run = FAN

    def _near(self, level: int, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        mask, pattern = self.levels[level]
        return np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= most

    def leaf_pairs(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of pairs (a <= b) of leaves that no shared bits keep apart."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        a, b = np.triu_indices(n)
        stack = [(top, a.astype(np.int64), b.astype(np.int64))]
        while stack:
            level, a, b = stack.pop()
            near = self._near(level, a, b, most)
            a, b = a[near], b[near]
            if level == 0:
                if len(a):
                    yield a, b
                continue
            n, step = len(self.levels[level - 1][0]), max(1, 500_000 // (FAN * FAN))
            for at in range(0, len(a), step):
                x = (a[at : at + step, None, None] * FAN + np.arange(FAN)[None, :, None]) + np.zeros((1, 1, FAN), np.int64)
                y = (b[at : at + step, None, None] * FAN + np.arange(FAN)[None, None, :]) + np.zeros((1, FAN, 1), np.int64)
                x, y = x.ravel(), y.ravel()
                real = (x <= y) & (x < n) & (y < n)
                stack.append((level - 1, x[real], y[real]))

    def pairs(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of places of values that differ in ``most`` bits at most."""
        n, v = len(self.values), self.values
        offs = np.arange(LEAF)
        for a, b in self.leaf_pairs(most):
            for at in range(0, len(a), 1024):
                x, y = a[at : at + 1024, None] * LEAF + offs, b[at : at + 1024, None] * LEAF + offs
                # a value that the other leaf's shared bits keep away from all its members needs no comparison
                near = np.bitwise_count(v[np.minimum(x, n - 1)][:, :, None] ^ v[np.minimum(y, n - 1)][:, None, :]) <= most
                k, i, j = np.nonzero(near)
                i, j = x[k, i], y[k, j]
                real = (i < j) & (j < n)
                if real.any():
                    yield i[real], j[real]


def forest(n: int, blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Union-find: the smallest place reachable from each of ``n`` places."""
    root = np.arange(n)
    for a, b in blocks:
        while len(a):
            a, b = root[a], root[b]
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            open_ = lo < hi
            a, b = hi[open_], lo[open_]
            if not len(a):
                break
            np.minimum.at(root, a, b)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return x if not by else (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


#: The thirds as masks, signed as Spark's longs are.
THIRDS = [_signed(sum(1 << (63 - (s + k)) % 64 for k in range(w))) for s, w in zip(ROTATIONS, TOP)]


def parts_of(mask: int) -> list[int]:
    """The mask with each of three parts of the other bits; in bits of 64, signed."""
    free = [k for k in range(64) if not mask >> k & 1]
    cuts = [round(i * len(free) / 3) for i in range(4)]
    return [_signed((mask & (1 << 64) - 1) | sum(1 << k for k in free[a:b])) for a, b in zip(cuts, cuts[1:])]


def _search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Links inside the groups of a slice; ``key``: mask, slice."""
    values, mask, by = part["fp"].to_numpy(np.int64).view(np.uint64), int(key[0]), 0
    if mask in THIRDS:  # all groups in one index, the shared third on top
        by, groups = ROTATIONS[THIRDS.index(mask)], [values]
    else:
        shared = values & np.uint64(mask & (1 << 64) - 1)
        order = np.argsort(shared, kind="stable")
        groups = np.split(values[order], np.flatnonzero(np.diff(shared[order])) + 1)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for own in groups:
        if len(own) > 1:
            index = GrayIndex(_rotate(own, by))
            root = forest(len(own), index.pairs(DISTANCE))
            back = _rotate(index.values, (64 - by) % 64).view(np.int64)
            linked = root != np.arange(len(root))
            a.append(back[linked])
            b.append(back[root[linked]])
    return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``distinct`` (fp), enough to connect all that link."""
    slices = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), distinct.count() // SLICE + 1)
    found = None
    open_ = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in THIRDS])).alias("mask"))
    while True:
        keyed = open_.withColumn("shared", F.col("fp").bitwiseAND(F.col("mask")))
        crowded = materialise(keyed.groupBy("mask", "shared").count().where(F.col("count") > hot).select("mask", "shared"), "simhash-crowded")
        last = crowded.isEmpty()
        fits = keyed if last else keyed.join(crowded, ["mask", "shared"], "left_anti")
        fits = fits.withColumn("slice", F.pmod(F.xxhash64("shared"), F.lit(slices)).cast("int"))
        own = fits.groupBy("mask", "slice").applyInPandas(_search, "a long, b long")
        found = own if found is None else found.union(own)
        if last:
            return found
        masks = [r["mask"] for r in crowded.select("mask").distinct().collect()]  # 3 at most in the first round, then 9, 27, 81
        narrower = F.create_map(*[F.lit(x) for m in masks for x in (m, ",".join(map(str, parts_of(m))))])
        open_ = keyed.join(crowded, ["mask", "shared"], "left_semi").select("fp", F.explode(F.transform(F.split(narrower[F.col("mask")], ","), lambda x: x.cast("long"))).alias("mask"))
        open_ = materialise(open_.distinct(), "simhash-open")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, fingerprint (hex), component_id, component, text_hash."""
    rows = fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    rows = materialise(rows.select("doc_id", "fp", F.xxhash64("text").alias("text_hash")), "simhash-rows")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    member = components(links(distinct.select("fp"), hot)).withColumnRenamed("node", "fp")
    member = materialise(member, "simhash-members")
    placed = distinct.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialise(placed.join(smallest, "component").select("fp", "component", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component", "text_hash")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id; of repeated rows one."""
    return keep_first(docs, near_components(docs, id_col, text_col), id_col, text_col)


def keep_first(docs: DataFrame, placed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of each component of ``placed`` (doc_id, text_hash, component) the document of the smallest id."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    stays = placed.groupBy("component").agg(F.min(order).alias("s")).select(F.col("s.id").alias("__id"), F.col("s.h").alias("__stays"))
    keyed = docs.withColumn("__h", F.xxhash64(F.col(text_col)))
    kept = keyed.join(stays, keyed[id_col].eqNullSafe(stays["__id"]) & (keyed["__h"] == stays["__stays"]))
    return kept.dropDuplicates([id_col, "__h"]).select(*[F.col(c) for c in docs.columns])
