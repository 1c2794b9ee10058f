"""Language-model scoring by subword lattices.

The model draws pieces of an existing public vocabulary one after the other.
A text's probability is the sum over all ways to cut it into pieces, worked
out by the forward recursion in log space.  Pieces never cross words, so the
lattice of a text is a chain of word lattices, and each distinct word is
scored once for the whole corpus.  Every single byte is a piece too, so every
text has a probability.

The vocabulary file's scores give the first weights; passes of expectation
(forward and backward over the counted words of the training part) improve them
until a pass gains less than ``STALLED`` of a natural log a word, or ``PASSES``
were made.  Word counts are a Spark aggregation over all training rows; what
reaches the driver is one number for each piece of the vocabulary.  Sums are
added in the order in which tasks end, so reruns may differ in the last bits.

Words that occur often - ``BROADCAST`` at most, of 64 bytes at most - are
looked up beside the text; every other (document, word) pair is joined with
the table of words, and documents are summed up afterwards.

Defined results: null and empty texts have one token, the end; without
training rows all counts are 0; repeated rows each get their row; an empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_fold, materialise

BROADCAST, LONGEST = 200_000, 64
#: Distinct words that a task holds before it passes their counts on.
HELD = 400_000
PRIOR = 0.5
PASSES, STALLED = 5, 0.02
END = b""


def held_out(doc_id: Column) -> Column:
    return doc_fold(doc_id, 5) == 1


class Pieces:
    """The pieces of a sentencepiece file as byte strings, and where they occur in words."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[bytes, float] = {}
        for k in range(model.get_piece_size()):
            if model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                continue
            found[model.id_to_piece(k).replace("▁", " ").encode()] = model.get_score(k)
        worst = min(found.values(), default=0.0)
        for b in range(256):
            found.setdefault(bytes([b]), worst)
        self.names = sorted(found)
        rank = -np.array([found[n] for n in self.names])
        first = np.log(1.0 / (50.0 + rank - rank.min()))
        self.first = first - np.logaddexp.reduce(first)
        mix = np.random.default_rng(20240101)
        self.byte = mix.integers(0, 1 << 63, 256, np.uint64) | np.uint64(1)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        hashes = np.array([self.prefix(np.frombuffer(n, np.uint8))[-1] for n in self.names], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        assert (np.diff(self.hashes) > 0).all(), "two pieces share a hash"
        self.lengths = sorted({len(n) for n in self.names})
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Rolling hashes of all prefixes: h[i+1] = h[i] * base + byte."""
        out = np.zeros(len(data) + 1, np.uint64)
        h, base, byte = 0, int(self.base), self.byte.tolist()
        for i, b in enumerate(data.tolist()):
            h = (h * base + byte[b]) & 0xFFFFFFFFFFFFFFFF
            out[i + 1] = h
        return out

    def arcs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words, each with a space before it: first places, lengths; start, size and piece of every arc.

        Place ``first[k] + i`` stands before byte i of word k, and each word has a place after its last byte.
        """
        sizes = np.array([len(w) + 1 for w in words])
        data = np.frombuffer(b"".join([b" " + w + b"\n" for w in words]), np.uint8)
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        ends = np.repeat(first + sizes, sizes + 1)  # the place after the word that a place belongs to
        starts, spans, pieces = [], [], []
        window = np.zeros(len(data), np.uint64)
        code = self.byte[data]
        at = np.arange(len(data))
        for n in range(1, self.lengths[-1] + 1):
            at = at[at + n <= ends[at]]
            if not len(at):
                break
            window[at] = window[at] * self.base + code[at + n - 1]
            h = window[at]
            maybe = self.seen[(h >> np.uint64(42)).astype(np.int64)]
            cand, h = at[maybe], h[maybe]
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            real = self.hashes[place] == h
            starts.append(cand[real])
            spans.append(np.full(int(real.sum()), n))
            pieces.append(self.order[place[real]])
        return first, sizes, np.concatenate(starts), np.concatenate(spans), np.concatenate(pieces)


def _groups(key: np.ndarray) -> Iterator[np.ndarray]:
    order = np.argsort(key, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else ()


class Lattice:
    def __init__(self, pieces: Pieces, logp: np.ndarray):
        self.pieces, self.logp = pieces, logp

    def forward(self, words: list[bytes]) -> tuple:
        first, sizes, start, span, piece = self.pieces.arcs(words)
        total = int(first[-1] + sizes[-1] + 1)
        alpha = np.full(total, -np.inf)
        alpha[first] = 0.0
        offset = np.repeat(first, sizes + 1)
        end, lp = start + span, self.logp[piece]
        for g in _groups((end - offset[start]) * 4096 + span):  # by end, then by size: no word twice in a group
            alpha[end[g]] = np.logaddexp(alpha[end[g]], alpha[start[g]] + lp[g])
        return first, sizes, start, end, piece, lp, offset, alpha

    def score(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        first, sizes, *_, alpha = self.forward(words)
        return alpha[first + sizes]

    def expect(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected uses of each piece in the counted words, and the words' log probability."""
        first, sizes, start, end, piece, lp, offset, alpha = self.forward(words)
        beta = np.full(len(alpha), -np.inf)
        last = first + sizes
        beta[last] = 0.0
        rest = np.repeat(last, sizes + 1)
        for g in _groups((rest[start] - start) * 4096 + end - start):
            beta[start[g]] = np.logaddexp(beta[start[g]], beta[end[g]] + lp[g])
        word = np.repeat(np.arange(len(words)), sizes + 1)[start]
        used = np.exp(alpha[start] + lp + beta[end] - alpha[last][word]) * counts[word]
        return np.bincount(piece, used, len(self.logp)), float((alpha[last] * counts).sum())


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """word (bytes, the end as empty), c: its count in the training rows, 0 for words of other rows only."""
    rows = docs.select(held_out(F.col(id_col)).alias("out"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, other, n = Counter(), set(), 0

        def passed() -> pd.DataFrame:
            seen.update(dict.fromkeys(other - seen.keys(), 0))
            return pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})

        for batch in batches:
            for out, text in zip(batch["out"].tolist(), batch["text"].tolist()):
                words = (text or "").encode().lower().split()
                if out:
                    other.update(words)
                    other.add(END)
                else:
                    seen.update(words)
                    seen[END] += 1
                n = len(seen) + len(other)
                if n > HELD:
                    yield passed()
                    seen, other = Counter(), set()
        if seen or other:
            yield passed()

    return rows.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def learn(counts: DataFrame, pieces: Pieces, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces, and of the end."""
    shared = counts.sparkSession.sparkContext.broadcast(pieces)
    words = counts.where((F.col("c") > 0) & (F.octet_length("word") > 0))
    ends = counts.where(F.octet_length("word") == 0).agg(F.sum("c")).first()[0] or 0
    n = words.agg(F.sum("c")).first()[0] or 0
    logp, log_end, before = pieces.first, 0.0, -math.inf
    for _ in range(passes):

        def expect(batches: Iterator[pd.DataFrame], weights: np.ndarray = logp) -> Iterator[pd.DataFrame]:
            total = None
            lattice = Lattice(shared.value, weights)
            for batch in batches:
                used = np.append(*lattice.expect(batch["word"].tolist(), batch["c"].to_numpy(float)))  # the log probability is last
                total = used if total is None else total + used
            if total is not None:
                yield pd.DataFrame({"piece": np.arange(len(total)), "used": total})[total != 0]

        used = np.zeros(len(pieces.names) + 1)
        for r in words.mapInPandas(expect, "piece int, used double").groupBy("piece").agg(F.sum("used").alias("used")).collect():
            used[r["piece"]] = r["used"]  # one for each piece of the vocabulary at most
        used, gained = used[:-1], used[-1] / max(n, 1)
        whole = used.sum() + ends + PRIOR * (len(used) + 1)
        logp, log_end = np.log((used + PRIOR) / whole), math.log((ends + PRIOR) / whole)
        if gained - before < STALLED:
            break
        before = gained
    return logp, log_end


def score(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", broadcast_words: int = BROADCAST) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    pieces = Pieces(vocabulary_path)
    counts = materialise(count_words(docs, id_col, text_col), "lm-counts")
    n, v = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    logp, log_end = learn(counts, pieces)
    model = spark.sparkContext.broadcast((pieces, logp))

    def lattice(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Lattice(*model.value)
        for batch in batches:
            words = batch["word"].tolist()
            found = np.full(len(words), log_end)
            real = [k for k, w in enumerate(words) if w]
            if real:
                found[real] = own.score([words[k] for k in real])
            yield pd.DataFrame({"word": words, "c": batch["c"], "score": found / math.log(10)})

    base = F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    table = materialise(counts.mapInPandas(lattice, "word binary, c long, score double").withColumn("base", base), "lm-words")

    # the commonest words whose number is known not to pass the bound
    step = F.floor(F.log2(F.col("c") + 1) * 16).cast("int")
    short = table.where(F.octet_length("word") <= LONGEST)
    least, held = None, 0
    for r in short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        held += r["count"]
        if held > broadcast_words:
            break
        least = r["step"]
    common = [] if least is None else short.where(step >= least).collect()
    words = {bytes(r["word"]): k for k, r in enumerate(common)}
    values = np.array([(r["c"] > 0, r["base"], r["score"]) for r in common] or np.zeros((0, 3)), float)
    looked_up = spark.sparkContext.broadcast((words, values))
    fields = "doc_id long, text_hash long, word binary, n long, rows int, n_tokens long, n_known long, base_score double, score double"

    def per_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, values = looked_up.value
        get = known.get
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                doc_id = None if doc_id is None or doc_id != doc_id else int(doc_id)
                data = (text or "").encode()
                words = data.lower().split()
                words.append(END)
                h = xxhash.xxh64_intdigest(data) - (1 << 63)
                places = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                own = values[places[places >= 0]].sum(axis=0)
                # the row of a document's sums has a word that no word is, so that such rows spread
                out.append((doc_id, h, b"\n%d" % h, 0, 1, len(words), int(own[0]), float(own[1]), float(own[2])))
                rare = Counter([w for w, p in zip(words, places.tolist()) if p < 0])
                out += [(doc_id, h, w, k, 0, 0, 0, 0.0, 0.0) for w, k in rare.items()]
                if len(out) > 100_000:
                    yield _frame(out)
                    out = []
            if out:
                yield _frame(out)

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])
        return frame.assign(doc_id=pd.array([r[0] for r in rows], "Int64"))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(per_document, fields)
    met = rows.join(table.select("word", "c", F.col("base").alias("w_base"), F.col("score").alias("w_score")), "word", "left")
    times = lambda c: F.coalesce(F.col("n") * F.col(c), F.lit(0.0))
    sums = met.groupBy("doc_id", "text_hash").agg(
        F.sum("rows").alias("rows"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base_score") + times("w_base")).alias("base_score"), F.sum(F.col("score") + times("w_score")).alias("score"),
    )
    # equal rows were added up: share the sums out again
    each = lambda c: (F.col(c) / F.col("rows")).alias(c)
    whole = lambda c: F.round(F.col(c) / F.col("rows")).cast("long").alias(c)
    return sums.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), whole("n_tokens"), whole("n_known"), F.lit(n).cast("long").alias("train_tokens"), each("base_score"), each("score"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("nth")).drop("nth")
