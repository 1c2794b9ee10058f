"""Repeated-passage removal by distributed prefix doubling.

A byte goes when it lies in a 50-byte string that also starts in a document
with a smaller id.  The rank of a position is a name of the bytes from there
on: equal bytes, equal rank.  A round names a longer prefix by the pair of
ranks at the position and at an offset (20 bytes, then 40 with offset 20, then
50 with offset 10, which is the threshold), Spark sorts the ranks, and positions
whose rank no other document has drop out before the next round.

Positions that need no rank of their own are left out:

1. Round of 20 bytes: a string enters with one position only, its minimizer
   (the 20 bytes of smallest name in it).  Equal strings have equal minimizers,
   so a string whose minimizer is unique is unique.
2. Past the threshold at once: neighbouring strings with one minimizer are a
   stretch of 50 to 80 bytes, named by the ranks of its two ends; one that a
   smaller document has too settles all its strings.
3. Round of 40 bytes: the minimizer with 20 bytes more, of which 0, 10 or 20
   stand before it, as the string has them.
4. Round of 50 bytes: neighbouring strings of one rank travel together as the
   80 bytes at most that they cover; Spark cuts them apart where they arrive and
   sorts rank and bytes, so equality here is that of the bytes themselves.

Every string is ranked at full length or proved unique on the way; nothing is
sampled.  (The smallest document that has a string is never settled by a
stretch, so it is there as a witness in each round.)  Texts are dealt once to
units of about ``UNIT`` bytes, kept in a table bucketed by unit, so that each
round's findings meet them without shuffling texts again.  A unit sends each
rank once, with the least and greatest of its documents that have it; so a rank
that a third of all documents share reaches the sort as one row a unit, and the
windows over a sorted rank only look at its first row and the neighbours.

Defined results: null text = empty text; texts under 50 bytes lose nothing and
are matched by nothing; a null id counts as greater than all others, and null
ids, or equal ids, do not remove each other's text; repeated rows each get
their row; an empty table gives an empty result; extra columns are not looked
at; very long texts are worked through in overlapping segments.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import delete
from .common import fresh_path, materialise, text_or_empty

LENGTH = 50
#: Bytes of the first rank, and the offsets of the pairs of the two rounds after it.
GRAM, OFFSETS = 20, (20, 10)
WINDOW = LENGTH - GRAM + 1
#: Bytes of text: of a unit, and of what is looked at together (small enough for a processor's cache).
UNIT, BLOCK = 4 << 20, 1 << 18
NO_ID = (1 << 63) - 1
#: Two families of names: of ranks, and of the stretches made of them.
MIX = np.array([[0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]], np.uint64)
GRAMS, STRETCHES, CONTEXTS, STRINGS = range(4)


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= by
    x ^= x >> np.uint64(29)
    return x


def _pair(a: np.ndarray, b: np.ndarray, family: int) -> np.ndarray:
    """The name of a pair of ranks."""
    one, two, three = MIX[family]
    return _mixed((a ^ a >> np.uint64(32)) * one + b * two, three)


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All places of the runs from ``first`` to ``last``."""
    n = last - first + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else first


class Block:
    """Texts, or segments of long ones, side by side, the ranks of their bytes, and the runs of strings with one minimizer."""

    def __init__(self, parts: list[tuple[int, int, bytes]], doc: np.ndarray):
        self.row = np.array([r for r, _, _ in parts])
        self.base = np.array([at for _, at, _ in parts])
        sizes = np.array([len(p) for _, _, p in parts])
        self.stop = np.cumsum(sizes)
        self.start = self.stop - sizes
        self.size = int(self.stop[-1])
        self.data = b"".join([p for _, _, p in parts]) + bytes(2 * LENGTH)
        self.gram = self.grams()
        places = _spread(self.start, self.stop - LENGTH) if (sizes >= LENGTH).all() else _spread(self.start[sizes >= LENGTH], self.stop[sizes >= LENGTH] - LENGTH)
        least = self.minimizers()[places]
        new = _starts(least)
        #: First and last place, and minimizer, of each run.
        self.first, self.min = places[new], least[new]
        self.last = places[np.append(new[1:], True)[: len(places)]]
        self.doc = doc[self.row[np.searchsorted(self.start, self.first, "right") - 1]]

    def grams(self) -> np.ndarray:
        n = self.size + LENGTH
        one, two, three = MIX[0]
        word = lambda at: np.ndarray((n,), "<u8", self.data, at, (1,))
        return _mixed((word(0) ^ word(GRAM - 8) * three) * one + word(8) * two, three)

    def minimizers(self) -> np.ndarray:
        """The place of the minimizer of the string at each place."""
        low = np.uint64(0xFFFFFFFF)
        n = self.size + WINDOW
        v = (self.gram[:n] & ~low) | np.arange(n, dtype=np.uint64)
        span = 1
        while 2 * span <= WINDOW:
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        v = np.minimum(v[: len(v) - (WINDOW - span)], v[WINDOW - span :])
        return (v[: self.size] & low).astype(np.int64)

    def rank40(self, places: np.ndarray) -> np.ndarray:
        return _pair(self.gram[places], self.gram[places + OFFSETS[0]], 0)

    def rank50(self, places: np.ndarray) -> np.ndarray:
        return _pair(self.rank40(places), self.rank40(places + OFFSETS[1]), 0)

    def keep(self, runs: np.ndarray) -> None:
        """Goes on with these runs only."""
        for name in ("first", "last", "min", "doc"):
            setattr(self, name, getattr(self, name)[runs])

    def stretches(self) -> np.ndarray:
        """Both names of each run: its minimizer's, and that of the ranks of its ends and their distance."""
        ends = self.rank50(np.concatenate([self.first, self.last]))
        n = len(self.first)
        return np.stack([self.gram[self.min], _pair(ends[:n], ends[n:] + (self.last - self.first).astype(np.uint64), 1)], 1)

    def contexts(self) -> np.ndarray:
        """40-byte ranks of the runs, which are cut where more of those bytes can stand before the minimizer."""
        # strings that start from ``before`` bytes before the minimizer on, up to the next step
        steps = [(before, self.min - before - (OFFSETS[1] - 1) if before < OFFSETS[0] else self.first, self.min - before) for before in range(0, OFFSETS[0] + 1, OFFSETS[1])]
        cuts = [(before, np.maximum(self.first, lo), np.minimum(self.last, hi)) for before, lo, hi in steps]
        some = [np.flatnonzero(lo <= hi) for _, lo, hi in cuts]
        first, last = (np.concatenate([c[k][own] for c, own in zip(cuts, some)]) for k in (1, 2))
        before = np.repeat(np.array([c[0] for c in cuts]), [len(own) for own in some])
        self.keep(np.concatenate(some))
        self.first, self.last = first, last
        return self.rank40(self.min - before) ^ before.astype(np.uint64)

    def bytes(self) -> list[bytes]:
        """What the strings of each run cover."""
        return [self.data[a:b] for a, b in zip(self.first.tolist(), (self.last + LENGTH).tolist())]


class Found:
    """What the rounds before told a unit: ranks of each kind, the least document that has them, and which strings of a run others have."""

    def __init__(self, rows: pd.DataFrame):
        self.kinds: dict[int, tuple[np.ndarray, ...]] = {}
        kind = rows["kind"].to_numpy()
        h, h2, least, mask = (rows[c].to_numpy(np.int64) for c in ("h", "h2", "least", "mask"))
        for k in np.unique(kind).tolist():
            own = np.flatnonzero(kind == k)
            a, b = h[own].view(np.uint64), h2[own].view(np.uint64)
            order = np.argsort(a ^ b)
            self.kinds[k] = (a ^ b)[order], a[order], least[own][order], mask[own][order]

    def _place(self, kind: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.kinds[kind][0]
        place = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return place, known[place] == values

    def has(self, kind: int, values: np.ndarray) -> np.ndarray:
        if kind not in self.kinds:
            return np.zeros(len(values), bool)
        return self._place(kind, values)[1]

    def before(self, kind: int, values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which of the values (both names) a document smaller than ``doc`` has too."""
        if kind not in self.kinds:
            return np.zeros(len(values), bool)
        place, same = self._place(kind, values[:, 0] ^ values[:, 1])
        _, first, least, _ = self.kinds[kind]
        return same & (first[place] == values[:, 0]) & (least[place] < doc)

    def masks(self, names: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Of the runs of the last round, the strings (bit k: the k-th) that a smaller document has; all, where one has the run."""
        if STRINGS not in self.kinds:
            return np.zeros(len(names), np.int64)
        place, same = self._place(STRINGS, names[:, 0] ^ names[:, 1])
        _, first, least, mask = self.kinds[STRINGS]
        same &= first[place] == names[:, 0]
        return np.where(same, np.where(least[place] < doc, -1, mask[place]), 0)

    def narrow(self, block: Block, shared: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Leaves the block the runs that no stretch settled (with ``shared``, of those whose minimizer is); returns the runs that one settled."""
        if shared:
            block.keep(self.has(GRAMS, block.gram[block.min]))
        settled = self.before(STRETCHES, block.stretches(), block.doc) if STRETCHES in self.kinds else np.zeros(len(block.first), bool)
        done = block.first[settled], block.last[settled]
        block.keep(~settled)
        return done


def _starts(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values starts."""
    return np.append(True, np.diff(x) != 0)[: len(x)]


def _blocks(rows: pd.DataFrame) -> Iterator[Block]:
    """All texts in blocks of about ``BLOCK`` bytes; long ones in segments that overlap by a string less a byte."""
    doc, parts, size = rows["doc"].to_numpy(np.int64), [], 0
    for row, t in enumerate(rows["text"].tolist()):
        for at in range(0, max(1, len(t) - LENGTH + 1), BLOCK):
            part = t[at : at + BLOCK + LENGTH - 1]
            parts.append((row, at, part))
            size += len(part)
            if size >= BLOCK:
                yield Block(parts, doc)
                parts, size = [], 0
    if parts:
        yield Block(parts, doc)


class Ranks:
    """The ranks of a unit, each once, with the least and greatest document."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, names: np.ndarray, doc: np.ndarray) -> None:
        names = names if names.ndim == 2 else np.stack([names, np.zeros_like(names)], 1)
        self.held.append((names[:, 0], names[:, 1], doc))

    def frame(self, unit: int, texts: list[bytes] | None = None) -> pd.DataFrame:
        h, h2, doc = (np.concatenate([x[k] for x in self.held]) if self.held else np.zeros(0, np.uint64) for k in range(3))
        order = np.argsort(h ^ h2)
        h, h2, doc = h[order], h2[order], doc[order].astype(np.int64)
        cut = np.flatnonzero(_starts(h) | _starts(h2))
        lo, hi = (f.reduceat(doc, cut) if len(cut) else doc for f in (np.minimum, np.maximum))
        out = pd.DataFrame({"h": h[cut].view(np.int64), "h2": h2[cut].view(np.int64), "unit": np.int64(unit), "lo": lo, "hi": hi})
        return out if texts is None else out.assign(bytes=[texts[k] for k in order[cut].tolist()])


RANKS, NARROW = "h long, h2 long, unit long, lo long, hi long", "h long, unit long, many boolean"


def _grams(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    ranks = Ranks()
    for block in _blocks(rows):
        ranks.add(block.gram[block.min], block.doc)
    found = ranks.frame(rows["unit"].iat[0])
    return found[["h", "unit"]].assign(many=found["lo"] < found["hi"])


def _stretches(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    ranks, found = Ranks(), Found(marks)
    for block in _blocks(rows):
        found.narrow(block)
        ranks.add(block.stretches(), block.doc)
    return ranks.frame(rows["unit"].iat[0])


def _contexts(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    ranks, found = Ranks(), Found(marks)
    for block in _blocks(rows):
        found.narrow(block)
        ranks.add(block.contexts(), block.doc)
    return ranks.frame(rows["unit"].iat[0])


def _open_runs(block: Block, found: Found) -> np.ndarray:
    """Leaves the block the runs for the last round; their names: of the 40 bytes, and of all that they cover."""
    names = block.contexts()
    shared = found.has(CONTEXTS, names)
    block.keep(shared)
    return np.stack([names[shared], block.stretches()[:, 1]], 1)


def _runs(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    ranks, found, texts = Ranks(), Found(marks), []
    for block in _blocks(rows):
        found.narrow(block, shared=False)
        ranks.add(_open_runs(block, found), block.doc)
        texts += block.bytes()
    return ranks.frame(rows["unit"].iat[0], texts)


def _cut(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    texts, found = rows["text"].tolist(), Found(marks)
    gone = [np.zeros(len(t), bool) for t in texts]
    for b in _blocks(rows):
        edge = np.zeros(b.size + LENGTH + 1, np.int32)
        first, last = found.narrow(b, shared=False)
        np.add.at(edge, first, 1)
        np.add.at(edge, last + LENGTH, -1)
        masks = found.masks(_open_runs(b, found), b.doc)
        b.keep(masks != 0)
        places, n = _spread(b.first, b.last), b.last - b.first + 1
        hit = places[np.repeat(masks[masks != 0], n) >> (places - np.repeat(b.first, n)) & 1 == 1]
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + LENGTH, -1)
        covered = np.cumsum(edge[: b.size]) > 0
        for row, at, start, stop in zip(b.row.tolist(), b.base.tolist(), b.start.tolist(), b.stop.tolist()):
            gone[row][at : at + stop - start] |= covered[start:stop]
    out = []
    for text, own in zip(texts, gone):
        if not own.any():
            out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text))
            continue
        kept = np.frombuffer(text, np.uint8)[~own].tobytes()
        out.append((len(text), int(own.sum()), int(own[0]) + int((~own[:-1] & own[1:]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    done = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return done.assign(doc_id=pd.array(rows["doc"].to_numpy(), "Int64").copy()).assign(doc_id=lambda d: d["doc_id"].where(rows["known"].to_numpy(bool)))


def _placed(ranks: DataFrame, order_by: str, *rank: str) -> DataFrame:
    """``ranks`` in the order of a sort, with the first row of each rank, and whether there is another; nothing is held."""
    order = Window.partitionBy(*rank).orderBy(order_by)
    first = F.first(order_by).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranks.withColumn("least", first).withColumn("shared", F.lag(order_by).over(order).isNotNull() | F.lead(order_by).over(order).isNotNull())


def _marks(ranks: DataFrame, name: str, kind: int, h2: str | None = None, least: str | None = None, mask: str | None = None) -> DataFrame:
    """What the units are told, written."""
    value = lambda c, out: (F.lit(0).cast("long") if c is None else F.col(c)).alias(out)
    return materialise(ranks.select("unit", F.lit(kind).cast("byte").alias("kind"), "h", value(h2, "h2"), value(least, "least"), value(mask, "mask")), name)


def _last_round(runs: DataFrame) -> DataFrame:
    """The runs with a string that a smaller document has: bit k of ``mask`` for the k-th, as the least document of the unit sees it."""
    one = lambda k: F.col("bytes").substr(k, F.lit(LENGTH))
    cut = F.transform(F.sequence(F.lit(1), F.octet_length("bytes") - (LENGTH - 1)), one)
    each = runs.repartition("h").select("h", "h2", "unit", "lo", "hi", F.posexplode(cut).alias("k", "s"))
    order = Window.partitionBy("h", "s").orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k"))
    each = each.withColumn("bit", F.when(F.first("lo").over(order) < F.col("lo"), bit).otherwise(0))
    return each.groupBy("h", "h2", "unit", "lo", "hi").agg(F.sum("bit").alias("mask")).where("mask <> 0 or lo < hi")


def _dealt(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, path: str) -> str:
    """Writes the texts by unit to ``path``; returns the name of the table."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-size // UNIT) or 1)).alias("unit")
    rows = rows.select(unit, F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.col("doc_id").isNotNull().alias("known"), F.col("text").cast("binary").alias("text"))
    table = f"texts_{uuid.uuid4().hex}"
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit").option("compression", "zstd").option("path", path).saveAsTable(table)
    return table


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "repeats-texts")
    table = _dealt(spark, docs, id_col, text_col, path)
    try:
        return _without_repeats(spark, spark.table(table), keep_bytes)
    finally:
        spark.sql(f"DROP TABLE {table}")
        delete(spark, path)


def _without_repeats(spark: SparkSession, texts: DataFrame, keep_bytes: bool) -> DataFrame:
    """The rounds over the texts by unit; the result is a table of its own."""
    none = spark.createDataFrame([], "unit long, kind byte, h long, h2 long, least long, mask long")

    def step(function: Callable, schema: str, *told: DataFrame) -> DataFrame:
        marks = reduce(DataFrame.union, told, none)
        return texts.groupBy("unit").cogroup(marks.groupBy("unit")).applyInPandas(function, schema)

    grams = _marks(_placed(step(_grams, NARROW), "unit", "h").where("many or shared"), "repeats-20", GRAMS)
    stretches = _marks(_placed(step(_stretches, RANKS, grams), "lo", "h", "h2").where("least < hi"), "repeats-stretches", STRETCHES, "h2", "least")
    contexts = _marks(_placed(step(_contexts, RANKS, grams, stretches), "lo", "h").where("shared or lo < hi"), "repeats-40", CONTEXTS)
    strings = _marks(_last_round(step(_runs, RANKS + ", bytes binary", stretches, contexts)), "repeats-50", STRINGS, "h2", "lo", "mask")
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    names = [f.split()[0] for f in fields.split(", ")]
    return materialise(step(lambda rows, found: _cut(rows, found)[names], fields, stretches, contexts, strings), "repeats-result")
