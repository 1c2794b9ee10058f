"""Language identification by cross-parsing.

A suffix automaton is built over a bounded sample of labelled text of each
language.  A text is parsed greedily against each: every phrase is the longest
match that the automaton has.  Text in the automaton's language needs few
phrases.  ``phrases * log2(sample length) / text length`` estimates the cross
entropy in bits a character; the smallest wins.

The parse runs over many texts side by side with numpy, one step for each
character and language; once fewer than ``ALONE`` are still going, each of those
is parsed to its end by itself.  No text is cut.  The alphabet is made of all
letters of the sample, whatever their number: an automaton is kept as one array
of arcs into which the states' rows are fitted, so its size is that of its arcs.
A letter that no sample has is a phrase of its own in every language.

Parameter ``sample_chars`` bounds the labelled text that is kept for each
language; rows are chosen by a hash of their text, whole where they fit.

Defined results: null text, or text without a letter: ``und``, score 0; no
labelled text at all: every row ``und``; one language only: it wins with score
1; ties go to the smaller language name; labels that are null are not learned;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_fold

SAMPLE_CHARS = 50_000
#: Texts that are worth a numpy step, and characters that are looked at together.
ALONE, TOGETHER = 24, 6 << 20
#: Symbols: 0 a run of anything but letters, 1 a letter that the sample lacks, then the letters of the sample.
GAP, OTHER = 0, 1


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


@lru_cache(maxsize=1)
def _lower_case() -> np.ndarray:
    """Code point -> code point of the lower-case letter, or 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


def symbol_table(letters: str) -> np.ndarray:
    """Code point -> symbol, upper case as lower case."""
    low = _lower_case()
    own = np.full(0x110000, OTHER, np.int32)
    own[0] = GAP
    own[[ord(c) for c in letters]] = np.arange(2, 2 + len(letters))
    return own[low]


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """Letters as symbols; each run of anything else as one gap."""
    s = table[_code_points(text)]
    if not len(s):
        return s
    keep = s != GAP
    keep[1:] |= s[:-1] != GAP
    return s[keep]


def suffix_automaton(s: list[int]) -> list[tuple[int, int, int]]:
    """(state, symbol, next state) of the automaton of all substrings of ``s``; state 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in s:
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p, last = last, new
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p < 0:
            continue
        q = to[p][c]
        if length[q] == length[p] + 1:
            link[new] = q
            continue
        twin = len(to)
        to.append(dict(to[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = link[new] = twin
        while p >= 0 and to[p].get(c) == q:
            to[p][c] = twin
            p = link[p]
    return [(a, c, b) for a, out in enumerate(to) for c, b in out.items()]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_chars: int = SAMPLE_CHARS) -> dict:
    """The model: symbol assignment, and for each language the arcs of its automaton.

    Collects at most about three times ``sample_chars`` characters a language.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    rows = rows.withColumn("u", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 32)) / F.lit(float(1 << 32)))
    head = F.substring("text", 1, sample_chars).alias("text")
    sizes = {r["lang"]: (r["n"], r["one"]) for r in rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n"), F.min(F.struct("u", head)).alias("one")).collect()}
    if not sizes:
        return {"letters": "", "langs": []}
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(3.0 * sample_chars / max(n, 1))) for lang, (n, _) in sizes.items()])
    chosen = rows.where(F.col("u") < share).select("lang", "u", head).distinct().collect()
    texts: dict[str, list[str]] = {}
    for lang, (_, one) in sorted(sizes.items()):
        own = sorted({(one["u"], one["text"]), *((r["u"], r["text"]) for r in chosen if r["lang"] == lang)})
        kept, size = [], 0
        for _, text in own:
            if not kept or size + len(text) <= sample_chars:
                kept.append(text)
                size += len(text)
        texts[lang] = kept
    low = _lower_case()
    seen = np.unique(np.concatenate([low[_code_points(t)] for own in texts.values() for t in own]))
    letters = "".join(chr(c) for c in seen.tolist() if c)
    table, langs = symbol_table(letters), []
    for lang, own in texts.items():
        s = np.concatenate([np.append(symbols_of(t, table), np.int32(GAP)) for t in own])
        langs.append((lang, len(s), pack(suffix_automaton(s.tolist()), 2 + len(letters))))
    return {"letters": letters, "langs": langs}


def pack(arcs: list[tuple[int, int, int]], symbols: int) -> dict[str, np.ndarray]:
    """The arcs of an automaton in one array: state ``a`` has its arc of symbol ``c`` at ``base[a] + c`` if that place is its own.

    Rows are fitted into each other's gaps, those with most arcs first, each near
    where the last one went; single arcs then fill what is free from the start.
    The start state's row stands apart, by symbol.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for a, c, b in arcs:
        rows.setdefault(a, []).append((c, b))
    states = max((b for _, _, b in arcs), default=0) + 1
    root = np.zeros(symbols, np.int32)
    for c, b in rows.pop(0, []):
        root[c] = b
    base, owner, to = np.zeros(states, np.int32), [-1] * (2 * symbols), [0] * (2 * symbols)
    free = near = symbols  # no place before ``free`` is free
    for a in sorted(rows, key=lambda a: -len(rows[a])):
        row = sorted(rows[a])
        first, at, tried = row[0][0], near if len(row) > 1 else free, 0
        while True:
            while at + symbols >= len(owner):
                owner += [-1] * len(owner)
                to += [0] * len(to)
            if owner[at] < 0 and all(owner[at - first + c] < 0 for c, _ in row[1:]):
                break
            at, tried = at + 1, tried + 1
        if tried > 100:
            near = at
        base[a] = at - first
        for c, b in row:
            owner[at - first + c], to[at - first + c] = a, b
        while owner[free] >= 0:
            free += 1
    end = len(owner) if not rows else max(k for k, o in enumerate(owner) if o >= 0) + symbols + 1
    return {"root": root, "base": base, "owner": np.array(owner[:end] + [-1] * symbols, np.int32), "to": np.array(to[:end] + [0] * symbols, np.int32)}


class Parser:
    """Counts the phrases of texts against every language of a model."""

    def __init__(self, model: dict):
        self.table = symbol_table(model["letters"])
        self.names = [lang for lang, _, _ in model["langs"]]
        self.bits = [np.log2(max(n, 2)) for _, n, _ in model["langs"]]
        self.arcs = [arcs for _, _, arcs in model["langs"]]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        sizes = np.array([len(texts[k]) for k in order], np.int64)
        out = np.zeros((len(texts), len(self.arcs)), np.int64)
        if not len(texts) or not sizes[0]:
            return out
        data = np.concatenate([texts[k] for k in order])
        start = np.cumsum(sizes) - sizes
        together = int(sizes[ALONE - 1]) if len(sizes) >= ALONE else 0
        live = np.searchsorted(-sizes, -np.arange(together))  # texts longer than t
        states = np.zeros((len(self.arcs), len(texts)), np.int32)
        counts = np.zeros_like(states)
        for t, n in enumerate(live.tolist()):
            c = data[start[:n] + t]
            for arcs, state, count in zip(self.arcs, states, counts):
                own = state[:n]
                at = arcs["base"][own] + c
                known = arcs["owner"][at] == own
                state[:n] = np.where(known, arcs["to"][at], arcs["root"][c])
                count[:n] += ~known
        for k in np.flatnonzero(sizes > together).tolist():
            rest = data[start[k] + together : start[k] + sizes[k]].tolist()
            for lang, arcs in enumerate(self.arcs):
                base, owner, to, root = (memoryview(arcs[x]) for x in ("base", "owner", "to", "root"))
                state, n = int(states[lang, k]), 0
                for c in rest:
                    at = base[state] + c
                    if owner[at] == state:
                        state = to[at]
                    else:
                        n, state = n + 1, root[c]
                counts[lang, k] += n
        out[order] = counts.T
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        symbols = [symbols_of(t, self.table) if t else np.zeros(0, np.int32) for t in texts]
        symbols = [s if (s != GAP).any() else s[:0] for s in symbols]
        if not self.names:
            return [("und", 0.0)] * len(texts)
        sizes = np.array([len(s) for s in symbols])
        entropy = self.phrases(symbols) * np.array(self.bits) / np.maximum(sizes, 1)[:, None]
        order = np.argsort(entropy, axis=1, kind="stable")
        best = order[:, 0]
        out = []
        for k, n in enumerate(sizes.tolist()):
            if not n:
                out.append(("und", 0.0))
            elif len(self.names) == 1:
                out.append((self.names[0], 1.0))
            else:
                first, second = entropy[k, order[k, :2]]
                out.append((self.names[best[k]], float(1 - first / second)))
        return out


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts, about ``TOGETHER`` characters at a time."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "") + 100
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def identify(docs: DataFrame, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", out_col: str = "lang_id", sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``docs`` with a struct ``out_col``: lang_pred, score (0 to 1: how far the runner-up stays behind)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled, text_col, lang_col, sample_chars))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = Parser(model.value)
        for batch in batches:
            rows: list[tuple[str, float]] = []
            for texts in _portions(batch.tolist()):
                rows += parser.predict(texts)
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return docs.withColumn(out_col, predict(F.col(text_col)))


def held_out(doc_id: Column) -> Column:
    return doc_fold(doc_id, 4) == 2
