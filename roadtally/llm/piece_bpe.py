"""SentencePiece BPE in vectorised merge rounds.

A text becomes one flat array of symbols (ids of pieces; characters that are no
piece keep a number of their own), cut into words wherever no piece of the
model spans two neighbouring characters.  Each round looks up the rank of every
neighbouring pair, takes the least rank of each word by a segmented minimum,
merges its leftmost occurrences that don't overlap all at once, and compacts
the array; words without a pair left drop out, and the rounds end when none
remains.

The library merges one pair at a time, best score first, then leftmost.  A
round gives the same as long as none of its merges makes a pair of the same or
a better rank, which would have come before the next occurrence.  Every round
checks that for the pairs that it makes, also those that exist only between two
of its merges; a word in which it fails (a run of spaces, whose pieces share
one score) is taken back and finished by a queue of its pairs.

Words are remembered in a bounded table.  Models are those of type BPE that
don't normalise and put one space before the text.

Defined results: null text = empty text = only the begin and end ids; ids and
decoded text equal those of the sentencepiece library; characters without a
piece are their bytes; a text is never cut, and long texts are taken in
portions that end between words; other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from codecs import register_error
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Words remembered in each of two generations; letters of the longest remembered word; letters of a portion.
MEMO, LONGEST, PORTION = 250_000, 64, 1 << 20
#: Words end before a run of spaces, and lines end at their feeds (checked against the pieces).
WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")
#: A place at which a portion can end.
BETWEEN = re.compile(f"[^{SPACE}](?={SPACE})|\n")

register_error("piece_bpe.each", lambda e: ("�", e.start + 1))


class Lookup:
    """A hash table of numbers in numpy, asked with whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.bits = max(8, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, missing, np.int32)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):  # the first of those that want one free slot gets it
            free = self.keys[at[left]] < 0
            slots, first = np.unique(at[left][free], return_index=True)
            won = left[free][first]
            self.keys[slots], self.values[slots] = keys[won], values[won]
            left = left[~np.isin(left, won)]
            at[left] = (at[left] + 1) & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = self.values[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (1 << self.bits) - 1
            found = self.keys[at[open_]]
            out[open_] = self.values[at[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return out


class PieceModel:
    """Pieces of a sentencepiece file, the pairs that merge to them, and the rounds."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        plain: dict[str, int] = {}
        self.table = [b""] * self.size
        self.bytes = np.zeros(256, np.int32)
        self.control = {i for i in range(self.size) if model.IsControl(i)}
        for i in range(self.size):
            piece = model.IdToPiece(i)
            if model.IsByte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.table[i] = bytes([int(piece[3:5], 16)])
            elif model.IsUnknown(i):
                self.table[i] = " ⁇ ".encode()
            elif i not in self.control:
                plain[piece] = i
                self.table[i] = piece.replace(SPACE, " ").encode()
        #: Pieces that begin with a space.
        self.spaced = {i for piece, i in plain.items() if piece.startswith(SPACE)}
        #: Symbol of each character: its piece, or a number beyond the pieces.
        self.symbols = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        for piece, i in plain.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        score = {i: model.GetScore(i) for i in plain.values()}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.full(self.size + 1, NONE, np.int32)
        for i, s in score.items():
            self.rank[i] = order[s]
        symbol = lambda part: plain.get(part, self.size + ord(part) if len(part) == 1 else None)
        pairs, beside = {}, set()
        for piece, i in plain.items():
            for k in range(1, len(piece)):
                beside.add(ord(piece[k - 1]) << 21 | ord(piece[k]))
                a, b = symbol(piece[:k]), symbol(piece[k:])
                if a is not None and b is not None:
                    pairs[a << 21 | b] = i
        self.merges = pairs
        self.pairs = Lookup(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32), self.size)
        self.beside = Lookup(np.array(sorted(beside), np.int64), np.ones(len(beside), np.int32), 0)
        spans = any(k & 0x1FFFFF == ord(SPACE) and k >> 21 != ord(SPACE) or 10 in (k >> 21, k & 0x1FFFFF) for k in beside)
        self.words = re.compile("(?s).+") if spans else WORDS
        self.between = None if spans else BETWEEN
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def queue(self, symbols: list[int]) -> list[tuple[int, int]]:
        """The plain rule for one word: best rank, then leftmost, one pair at a time.  Pairs of place and symbol."""
        n, merges, rank = len(symbols), self.merges, self.rank
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []
        symbols = [*symbols]

        def offer(a: int) -> None:
            if a >= 0 and (b := after[a]) < n:
                made = merges.get(symbols[a] << 21 | symbols[b])
                if made is not None:
                    heapq.heappush(heap, (int(rank[made]), a, b, symbols[a], symbols[b], made))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, b, x, y, made = heapq.heappop(heap)
            if symbols[a] != x or symbols[b] != y or after[a] != b:
                continue
            symbols[a], symbols[b] = made, -1
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a])
            offer(a)
        return [(k, s) for k, s in enumerate(symbols) if s >= 0]

    def rounds(self, sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and symbols that are left of flat ``sym``; ``first`` marks where words start."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        pos = np.arange(len(sym), dtype=np.int64)
        made = np.full(len(sym), self.size, np.int32)

        def look(at: np.ndarray) -> None:
            """Pairs of the symbols at these places with their right neighbours in the word."""
            inner = at[(at + 1 < len(sym)) & ~first[np.minimum(at + 1, len(sym) - 1)]]
            made[at] = self.size
            made[inner] = self.pairs.get(sym[inner].astype(np.int64) << 21 | sym[inner + 1])

        look(np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(first)
            lengths = np.diff(starts, append=len(sym))
            ranks = self.rank[made]
            least = np.minimum.reduceat(ranks, starts)
            live = np.repeat(least < NONE, lengths)
            if not live.all():  # compaction: words without a pair are complete
                done.append((pos[~live], sym[~live]))
                sym, pos, first, made = sym[live], pos[live], first[live], made[live]
                continue
            word = np.repeat(np.arange(len(starts)), lengths)
            hits = np.flatnonzero(ranks == least[word])
            fresh = np.diff(hits, prepend=-2) > 1
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
            pick = hits[(np.arange(len(hits)) - head) % 2 == 0]
            several = np.bincount(word[pick], minlength=len(starts)) > 1
            # the pair of a merged symbol with the next one as it was before the round
            after = pick[pick + 2 < len(sym)]
            after = after[~first[after + 2] & several[word[after]]]
            between = self.rank[self.pairs.get(made[after].astype(np.int64) << 21 | sym[after + 2])]
            late = np.zeros(len(starts), bool)
            late[word[after][between <= least[word[after]]]] = True
            old = (sym, pos, first, made, starts, lengths)
            keep = np.ones(len(sym), bool)
            keep[pick + 1] = False
            sym = sym.copy()
            sym[pick] = made[pick]
            at = (np.cumsum(keep) - 1)[pick]
            sym, pos, first, made, word = sym[keep], pos[keep], first[keep], made[keep], word[keep]
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            look(changed)
            late[word[changed][self.rank[made[changed]] <= least[word[changed]]]] = True
            late &= several
            if late.any():
                o_sym, o_pos, _, _, o_starts, o_lengths = old
                for w in np.flatnonzero(late):
                    a = o_starts[w]
                    left = self.queue(o_sym[a : a + o_lengths[w]].tolist())
                    done.append((o_pos[a + np.array([k for k, _ in left])], np.array([s for _, s in left], np.int32)))
                stay = ~late[word]
                sym, pos, first, made = sym[stay], pos[stay], first[stay], made[stay]
        if not done:
            return pos, sym
        pos, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(pos)
        return pos[order], sym[order]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, little-endian unsigned 32-bit."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        first = np.ones(len(chars), bool)
        first[1:] = self.beside.get(chars[:-1] << 21 | chars[1:]) == 0
        first[ends[:-1]] = True
        pos, sym = self.rounds(self.symbols[chars], first)
        cuts = np.searchsorted(pos, ends)
        strange = np.flatnonzero(sym >= self.size)
        if len(strange):  # characters without a piece: their bytes
            spelt = [chr(c).encode() for c in (sym[strange] - self.size).tolist()]
            counts = np.ones(len(sym), np.int64)
            counts[strange] = list(map(len, spelt))
            places = np.cumsum(counts)
            out = np.repeat(sym, counts)
            out[np.repeat(sym >= self.size, counts)] = self.bytes[np.frombuffer(b"".join(spelt), np.uint8)]
            sym, cuts = out, np.concatenate([[0], places])[cuts]
        data, cuts = sym.astype("<u4").tobytes(), (cuts * 4).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def portions(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = self.between.search(text, at + PORTION) if self.between and len(text) - at > PORTION else None
            stop = end.end() if end else len(text)
            yield text[at:stop]
            at = stop

    def encode(self, texts: list[str], ends: bool = True) -> list[bytes]:
        """Ids of texts; with ``ends`` between the begin and end ids."""
        lists = [[self.words.findall(p) for p in self.portions(SPACE + t.replace(" ", SPACE))] if t else [] for t in texts]
        memo, older = self.memo, self.older
        new = [w for w in {w for portions in lists for ws in portions for w in ws} if w not in memo]
        found = {w: older[w] for w in new if w in older}
        new = [w for w in new if w not in found]
        if new:
            found.update(zip(new, self.encode_words(new)))
        begin, end = (np.array([k], "<u4").tobytes() if ends else b"" for k in (self.begin, self.end))
        out = [b"".join([begin, *(memo.get(w) or found[w] for ws in portions for w in ws), end]) for portions in lists]
        if len(memo) >= MEMO:
            self.memo, self.older = {}, memo
        self.memo.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST)
        return out

    def decode(self, ids: bytes) -> str:
        """The text: controls vanish, the space before the first piece goes, broken bytes become U+FFFD."""
        known = np.frombuffer(ids, "<u4").tolist()
        runs = [list(run) for control, run in groupby(known, self.control.__contains__) if not control]
        data = [b"".join(map(self.table.__getitem__, run)) for run in runs]
        if runs and runs[0][0] in self.spaced:
            data[0] = data[0][1:]
        return "".join([d.decode("utf-8", "piece_bpe.each") for d in data])


@lru_cache(maxsize=2)
def shared_model(path: str) -> PieceModel:
    """One for each Python worker, so that later tasks find what earlier ones remember."""
    return PieceModel(path)


def portions_of_batch(texts: list[str], chars: int = 1 << 22) -> Iterator[list[str]]:
    """Neighbouring texts of some length together, so that few words are held at once."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_pieces(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "pieces") -> DataFrame:
    """``docs`` with a struct ``out_col``: ids (binary, begin and end ids included), n_tokens, ids_sha256, decoded_sha256."""

    @F.pandas_udf("ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared_model(path)
        for batch in batches:
            rows = []
            for texts in portions_of_batch([t or "" for t in batch]):
                for ids in model.encode(texts):
                    rows.append((ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(out_col, encode(F.col(text_col)))


def decode_pieces(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; a null ids column gives null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared_model(path)
        for batch in batches:
            yield pd.Series([None if ids is None else model.decode(ids) for ids in batch], dtype=object)

    return encoded.withColumn(out_col, decode(F.col(ids_col)))
