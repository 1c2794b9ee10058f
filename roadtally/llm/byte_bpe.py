"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string the encoding ends in exactly one token: the
one that ends there, and forms a stable pair with the last token of what stands
before it.  ``PrefixEncoder`` keeps that last token for each prefix, so bytes
can be appended, or an edit re-encoded, without starting over.  A pair (a, b)
is stable when merging a's and b's bytes by rank gives back a, b.

Each match of the splitting pattern is encoded by itself, and its ids are
remembered in a bounded table.

Defined results: null text = empty text = no ids; ids of a text equal those of
the tiktoken library for the same ranks and pattern without special tokens;
lone surrogates cannot occur in Spark strings; other columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, NOT_PLAIN

#: Fixed value: the public splitting pattern that ``PIECES`` stands for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The splitting pattern in the words of ``re``, for texts without characters that ``NOT_PLAIN`` finds.
PIECES = re.compile(rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+")
#: Matches remembered in each of two generations.
MEMO = 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks, and which pairs of neighbouring tokens can stand in an encoding."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        #: All ends of tokens, with their rank or -1: no longer token can end at a place once its end is not in here.
        self.ends = dict.fromkeys((token[i:] for token in ranks for i in range(len(token))), -1) | ranks
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """The plain rule: join the neighbouring pair of lowest rank until none is known."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stable(self, a: int, b: int) -> bool:
        """Works out a pair that isn't in ``pairs`` yet."""
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        x, y = self.tokens[a], self.tokens[b]
        found = self.pairs[a << 32 | b] = self.merge(x + y) == [x, y]
        return found


class PrefixEncoder:
    """The last token of each prefix of a growing byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the string; what was worked out for its prefixes stays."""
        self.data += more
        data, last, v = self.data, self.last, self.vocabulary
        ends, pairs = v.ends, v.pairs
        for end in range(len(last), len(data) + 1):
            for start in range(end - 1, -1, -1):
                part = data[start:end]
                token = ends.get(part)
                if token is None:
                    break
                if token < 0:
                    continue
                if start:
                    known = pairs.get(last[start] << 32 | token)
                    if not (v.stable(last[start], token) if known is None else known):
                        continue
                last.append(token)
                break
            if len(last) <= end:
                raise ValueError("a byte is missing from the vocabulary")

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace data[start:end]; what stands before the edit and far enough behind it keeps its tokens.

        A prefix's last token depends on the bytes and the last tokens of one
        longest token's length before it.  As soon as that many in a row behind
        the edit are what they were, all further ones are.
        """
        old, rest, shift, length = self.last, self.data[end:], len(new) - (end - start), self.vocabulary.longest
        self.data, self.last = self.data[:start], old[: start + 1]
        self.append(new)
        for at in range(0, len(rest), length):
            self.append(rest[at : at + length])
            first = len(self.last) - length
            if first > max(start + len(new), shift) and self.last[first:] == old[first - shift : len(self.last) - shift]:
                done = len(self.last)
                self.last += old[done - shift :]
                self.data += rest[at + length :]
                return

    def ids(self) -> list[int]:
        end, out = len(self.data), []
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, and decodes them."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.pattern = Vocabulary(load_ranks(path)), regex.compile(pattern)
        self.own = pattern == PATTERN
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        """Ids of a match that the newer table doesn't have."""
        out = self.older.get(piece)
        if out is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            ids = [whole] if whole is not None else PrefixEncoder(self.vocabulary, data).ids()
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.memo) >= MEMO:
                self.memo, self.older = {}, self.memo
            self.memo[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        plain = self.own and not NOT_PLAIN.search(text)
        pieces = PIECES.findall(text) if plain else self.pattern.findall(text)
        memo, make = self.memo, self.piece
        return b"".join([memo.get(p) or make(p) for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def shared_encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, so that later tasks find what earlier ones remember."""
    return Encoder(path, pattern)


def encode_bpe(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "bpe") -> DataFrame:
    """``docs`` with a struct ``out_col``: ids (binary), n_tokens, ids_sha256, decoded_sha256."""

    @F.pandas_udf("ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = shared_encoder(path, pattern)
        for batch in batches:
            rows = []
            for text in batch:
                ids = encoder.encode(text or "")
                rows.append((ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(out_col, encode(F.col(text_col)))


def decode_bpe(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of the text; a null ids column gives null."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(load_ranks(path))
        for batch in batches:
            yield pd.Series([None if ids is None else b"".join(map(vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())) for ids in batch], dtype=object)

    return encoded.withColumn(out_col, decode(F.col(ids_col)))
