"""Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Every row is a leaf: SHA-256 over its fields, each written with its length so
that no two rows give the same bytes.  Leaves of one value of ``tree_col``
ascend by ``order_col``; every ``ARITY`` consecutive nodes become one, until one
is left, and the roots of the trees are the leaves of one more tree.

Trees are kept as blocks, aligned subtrees of ``STEPS`` levels above at most
``WIDTH`` leaves.  Inside a block the nodes stand in van Emde Boas order: the
block is split at half its height, the upper subtree comes first, then the lower
ones from left to right, each laid out in the same way (``address``).  The same
arithmetic places nodes while a block is built and finds the siblings of a leaf,
so that neither follows pointers.  The roots of the blocks of one tier are the
leaves of the next tier's blocks, which makes the whole tree; blocks that are
not full are cut off behind their last node.

Spark sorts the leaves once by range (a tree may fill any number of ranges; equal
rows are told apart by their place in the input) and numbers them with the sizes
of the ranges.  A task then holds one block at a time.  Proofs go the other way:
from the top, every block hands the siblings above it to the blocks below.

Defined results: a null tree value is a tree of its own and comes first, a null
order value comes first, rows with equal order values stand by their leaf;
repeated rows are leaves of their own; an empty table gives an empty manifest
and no proofs; null fields are ``-``, empty texts ``0:``; only the named columns
are read, so that other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

ARITY_BITS = 3
ARITY = 1 << ARITY_BITS
#: Levels of a block above its leaves, and leaves of a full block.
STEPS = 3
WIDTH = ARITY**STEPS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Key of the tree over the roots; those of other trees are '' (null) or begin with '='.
TOP = "*"


def size(levels: int) -> int:
    """Nodes of a full subtree."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index):
    """Place of node ``index`` (a number or an array) of a depth, 0 being the root, in a subtree of ``levels`` levels."""
    if levels == 1:
        return index * 0
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    lower, below = levels - upper, depth - upper
    return size(upper) + (index >> ARITY_BITS * below) * size(lower) + address(lower, below, index & (1 << ARITY_BITS * below) - 1)


def levels_of(count: int, whole: bool) -> int:
    """Levels of a block of so many leaves: all when its tree goes on above it, else as many as it takes to get to one node."""
    levels = 1
    while count > 1 or whole and levels <= STEPS:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def build(leaves: bytes, levels: int) -> bytes:
    """The nodes of a block, 32 bytes each, from those of its leaves."""
    count = len(leaves) // 32
    out = np.zeros((int(address(levels, levels - 1, np.arange(count)).max()) + 1, 32), np.uint8)
    for depth in range(levels - 1, -1, -1):
        out[address(levels, depth, np.arange(len(leaves) // 32))] = np.frombuffer(leaves, np.uint8).reshape(-1, 32)
        text, run = leaves.hex().encode(), 64 * ARITY
        leaves = b"".join([hashlib.sha256(text[k : k + run]).digest() for k in range(0, len(text), run)])
    return out.tobytes()


def siblings(nodes: bytes, count: int, levels: int) -> list[bytes]:
    """For each leaf of a block its steps up to the block's root: place in the run, length of the run, the others' digests."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    leaf = np.arange(count)
    steps = []
    for depth in range(levels - 1, 0, -1):
        here = -(-count // ARITY ** (levels - 1 - depth))
        runs = {}
        for start in range(0, here, ARITY):
            found = table[address(levels, depth, np.arange(start, min(start + ARITY, here)))].tobytes()
            for k in range(len(found) // 32):
                runs[start + k] = bytes((k, len(found) // 32)) + found[: 32 * k] + found[32 * k + 32 :]
        steps.append([runs[i] for i in (leaf >> ARITY_BITS * (levels - 1 - depth)).tolist()])
    return [b"".join(s) for s in zip(*steps)] if steps else [b""] * count


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    at = 0
    while at < len(path):
        own, run = path[at], path[at + 1]
        others = path[at + 2 : at + 2 + 32 * (run - 1)]
        leaf = hashlib.sha256((others[: 32 * own] + leaf + others[32 * own :]).hex().encode()).digest()
        at += 2 + len(others)
    return leaf


def digest_of_path(path: bytes) -> bytes:
    """SHA-256 of all siblings of a path in order, as hex."""
    at, text = 0, []
    while at < len(path):
        end = at + 2 + 32 * (path[at + 1] - 1)
        text.append(path[at + 2 : end])
        at = end
    return hashlib.sha256(b"".join(text).hex().encode()).digest()


def leaf_digest(fields: Sequence[str | Column] = FIELDS) -> Column:
    """SHA-256 (binary) of a row's fields: ``-`` for null, else number of UTF-8 bytes, colon, value."""
    parts = []
    for f in fields:
        value = (F.col(f) if isinstance(f, str) else f).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 in each group by ``order``) and ``n`` (rows of the group)."""
    spark = rows.sparkSession
    keys = [group, *order]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    laid = materialise(laid.withColumn("range", F.shiftright("at", 33)), "merkle-sorted")
    w = Window.partitionBy(group).orderBy("range")
    sizes = laid.groupBy(group, "range").agg(F.min("at").alias("start"), F.count("*").alias("here"))
    sizes = sizes.withColumn("before", F.sum("here").over(w) - F.col("here")).withColumn("n", F.sum("here").over(Window.partitionBy(group)))
    sizes = materialise(sizes.drop("here"), "merkle-sizes")
    return laid.join(sizes, [group, "range"]).withColumn("pos", F.col("at") - F.col("start") + F.col("before")).drop("at", "range", "start", "before")


def blockwise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one block at a time, from batches that are sorted by tree and block."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        tree, block = batch["tree"].to_numpy(), batch["block"].to_numpy()
        cuts = [0, *(np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield batch.iloc[a:b]
        held = batch.iloc[cuts[-2] :]
    if held is not None and len(held):
        yield held


BLOCKS = "tree string, block long, n long, levels int, count int, nodes binary"


def _build_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for rows in blockwise(batches):
        n, count = int(rows["n"].iat[0]), len(rows)
        levels = levels_of(count, n > WIDTH)
        out.append((rows["tree"].iat[0], rows["block"].iat[0], n, levels, count, build(b"".join(rows["digest"]), levels)))
        if len(out) >= 256:
            yield pd.DataFrame(out, columns=["tree", "block", "n", "levels", "count", "nodes"])
            out = []
    yield pd.DataFrame(out, columns=["tree", "block", "n", "levels", "count", "nodes"])


def tiers(nodes: DataFrame, folder: str) -> list[DataFrame]:
    """Blocks of every tier above ``nodes`` (tree, pos, n, digest), written below ``folder``."""
    spark, out = nodes.sparkSession, []
    while True:
        rows = nodes.select("tree", F.expr(f"pos div {WIDTH}").alias("block"), "pos", "n", "digest").repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        path = f"{folder}/tier-{len(out)}"
        rows.mapInPandas(_build_all, BLOCKS).write.parquet(path)
        out.append(spark.read.schema(BLOCKS).parquet(path))
        above = out[-1].where(F.col("n") > WIDTH)
        if above.isEmpty():
            return out
        nodes = above.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"), F.substring("nodes", 1, 32).alias("digest"))


def build_manifest(docs: DataFrame, folder: str, fields: Sequence[str] = FIELDS, tree_col: str = "lang", order_col: str = "doc_id", beside: dict[str, Column] | None = None) -> None:
    """Write the leaves, the blocks of all tiers and the roots below ``folder``; columns ``beside`` stay with their leaves."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), F.col(order_col).alias("id"), leaf_digest(fields).alias("digest"), *[c.alias(name) for name, c in (beside or {}).items()])
    leaves = materialise(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    spark = docs.sparkSession
    numbered(leaves, "tree", ["id", "digest", "tie"]).drop("tie").write.parquet(f"{folder}/leaves")
    below = tiers(spark.read.parquet(f"{folder}/leaves").select("tree", "pos", "n", "digest"), f"{folder}/trees")
    roots = _union([b.where(F.col("n") <= WIDTH).select("tree", F.substring("nodes", 1, 32).alias("digest")) for b in below])
    roots = numbered(roots.select(F.lit(TOP).alias("top"), F.col("tree").alias("of"), "digest"), "top", ["of"])
    roots.select(F.col("top").alias("tree"), "of", "pos", "n", "digest").write.parquet(f"{folder}/roots")
    tiers(spark.read.parquet(f"{folder}/roots"), f"{folder}/top")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


HANDED = "tree string, block long, subroot binary, root binary, path binary"


def _hand_down(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The path of every leaf of every block, as that of a block of the tier below."""
    for batch in batches:
        for r in batch.itertuples(index=False):
            paths = siblings(r.nodes, r.count, r.levels)
            yield pd.DataFrame({"tree": r.tree, "block": r.block * WIDTH + np.arange(r.count), "subroot": r.subroot, "root": r.root, "path": [p + r.path for p in paths]})


def _read_tiers(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Tiers are read back from the folder: tier k + 1 exists where a tree has more than WIDTH nodes in tier k."""
    out = [spark.read.schema(BLOCKS).parquet(f"{folder}/tier-0")]
    while not out[-1].where(F.col("n") > WIDTH).isEmpty():
        out.append(spark.read.schema(BLOCKS).parquet(f"{folder}/tier-{len(out)}"))
    return out


def _paths(blocks: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Blocks of the lowest tier with the path above them; ``tops``: tree, subroot, root, path of each tree."""
    handed = None
    for tier in reversed(blocks):
        known = tier.where(F.col("n") <= WIDTH).join(tops, "tree")
        if handed is not None:
            known = known.unionByName(tier.where(F.col("n") > WIDTH).join(handed, ["tree", "block"]))
        handed = known.select("tree", "block", "subroot", "root", "path", "count", "levels", "nodes").mapInPandas(_hand_down, HANDED)
    return known


def proofs(spark: SparkSession, folder: str, presented: str = "digest", keep_path: bool = False) -> DataFrame:
    """A row for each leaf of a manifest: id, leaf, subroot, root, proof_sha256, folded_root, verified; all hex but the flag.

    ``presented`` names the column of digests to hold against the manifest, folded with the original siblings.
    """
    roots = spark.read.parquet(f"{folder}/roots")
    top = _read_tiers(spark, f"{folder}/top")
    root = top[-1].select("tree", F.substring("nodes", 1, 32).alias("root"))
    start = root.select("tree", F.lit(b"").alias("subroot"), "root", F.lit(b"").alias("path"))
    above = _paths(top, start).select("tree", "block", "subroot", "root", "path", "count", "levels", "nodes").mapInPandas(_hand_down, HANDED)
    tops = roots.join(above.select(F.col("block").alias("pos"), "root", "path"), "pos").select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    tops = materialise(tops, "merkle-tops")
    blocks = _paths(_read_tiers(spark, f"{folder}/trees"), tops)
    leaves = spark.read.parquet(f"{folder}/leaves")
    kind = leaves.schema["id"].dataType.simpleString()
    none = lambda name, t: F.lit(None).cast(t).alias(name)
    held = blocks.select("tree", "block", F.lit(-1).cast("long").alias("pos"), "count", "levels", "nodes", "subroot", "root", "path", none("id", kind), none("digest", "binary"), none("shown", "binary"))
    asked = leaves.select("tree", F.expr(f"pos div {WIDTH}").alias("block"), "pos", none("count", "int"), none("levels", "int"), none("nodes", "binary"), none("subroot", "binary"), none("root", "binary"), none("path", "binary"), "id", "digest", F.col(presented).alias("shown"))
    rows = held.unionByName(asked).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def prove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in blockwise(batches):
            block, rows = rows.iloc[0], rows.iloc[1:]
            paths = [p + block["path"] for p in siblings(block["nodes"], int(block["count"]), int(block["levels"]))]
            out = pd.DataFrame({"id": rows["id"], "leaf": [d.hex() for d in rows["digest"]], "subroot": block["subroot"].hex(), "root": block["root"].hex()})
            out["proof_sha256"] = [digest_of_path(p).hex() for p in paths]
            out["folded_root"] = [fold(d, p).hex() for d, p in zip(rows["shown"], paths)]
            out["verified"] = out["folded_root"] == out["root"]
            out["path"] = paths if keep_path else None
            yield out

    found = rows.mapInPandas(prove, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, path binary")
    return found if keep_path else found.drop("path")


def verify_path(leaf: Column, path: Column, root: Column) -> Column:
    """Does a digest (binary) with a kept path lead to a root (hex)?  Needs nothing of the manifest."""

    @F.pandas_udf("boolean")
    def check(leaf: pd.Series, path: pd.Series, root: pd.Series) -> pd.Series:
        return pd.Series([None if d is None or p is None or r is None else fold(d, p).hex() == r for d, p, r in zip(leaf, path, root)], dtype=object)

    return check(leaf, path, root)
