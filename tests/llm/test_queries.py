"""The registered queries themselves, over small tables written as the driver's are."""

import collections
import hashlib
import math
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from roadtally.llm import byte_bpe, lattice_lm, mixing
from roadtally.llm.queries import QUERIES

from .data import base_rows, frame
from .test_operators import KEY, exact_expected, fold, kept_expected, quality_expected, repeats_expected, shingle_bits, words

CONTRACT = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_lattice_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op5_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_lang_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10_mixing": ["doc_id", "size", "source_size", "target", "taken"],
}
ROWS = [(k, *r[1:]) for k, r in enumerate(base_rows())]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    frame(spark, ROWS).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def results(spark, folder):
    return {name: QUERIES[name](spark, folder) for name in CONTRACT}


def rows_of(results, name):
    return sorted((tuple(r) for r in results[name].select(*CONTRACT[name]).collect()), key=KEY)


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_and_rows(results, name):
    assert results[name].columns[: len(CONTRACT[name])] == CONTRACT[name] and results[name].count() == len(ROWS)
    assert {r["doc_id"] for r in results[name].select("doc_id").collect()} == {r[0] for r in ROWS}


def test_fingerprints(results):
    assert [r[:2] for r in rows_of(results, "op1_simhash")] == [(k, f"{shingle_bits(t):016x}") for k, t, *_ in ROWS]


def test_repeats(results):
    assert rows_of(results, "op3_suffix_dedup") == repeats_expected(ROWS)


def test_exact(results):
    assert len(exact_expected()) == len(ROWS)
    groups = collections.defaultdict(list)
    for k, t, *_ in ROWS:
        groups["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), k))
    expected = [(k, min(g)[1], len(g), min(g)[1] == k, hashlib.sha256(norm.encode()).hexdigest()) for norm, g in groups.items() for _, k in g]
    assert rows_of(results, "op4_exact_dedup") == sorted(expected)


def test_tokens(results):
    t, start, expected = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0, []
    for k, text, *_ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((k, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert rows_of(results, "op5_token_store") == expected


def test_byte_pairs(results):
    t = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    expected = []
    for k, text, *_ in ROWS:
        ids = t.encode_ordinary(text or "")
        expected.append((k, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows_of(results, "op6_byte_bpe") == expected


def test_languages(results):
    langs = {r[2] for r in ROWS} | {"und"}
    for (k, held, lang, score), (_, text, *_) in zip(rows_of(results, "op7_lang_id"), ROWS):
        assert held == (fold(k, 4) == 2) and lang in langs and 0 <= score <= 1
        assert (lang == "und") == (not any(c.isalpha() for c in text or ""))


def test_quality(results):
    from roadtally.llm import quality_rules

    verdict = dict(kept_expected([r[:4] for r in ROWS], quality_rules.BINS, quality_rules.SPREAD))
    assert rows_of(results, "op8_quality_rules") == [(k, *(q := quality_expected(t)), q[0] < 50 or 100 * q[4] > 50 * q[0], verdict[k]) for k, t, *_ in ROWS]


def test_shards(results):
    got = results["op9_sharding"].collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got} == {(k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "bytes", None) for k, t, *_ in ROWS}
    assert all(0 <= r["shard"] < 24 for r in got)
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_mix(results):
    size = {k: len(words(t)) for k, t, *_ in ROWS}
    whole = collections.Counter()
    for k, _, _, source in [r[:4] for r in ROWS]:
        whole[source] += size[k]
    plan = {s: (n, t) for s, n, t in mixing.targets(list(whole.items()))}
    for (k, n, source_size, target, taken), (_, _, _, source, *_) in zip(rows_of(results, "op10_mixing"), ROWS):
        assert (n, source_size) == (size[k], plan[source][0]) and abs(target - plan[source][1]) < 1e-6 and taken <= 3 * n and (n == 0 or taken % n == 0)


def test_scores_sum_all_segmentations(spark, tmp_path):
    """The whole model by brute force: every way to cut every word, in every pass of expectation."""
    texts = ["the cat", "The a the", "", None, "oté ca", "a a a", "zq", "cat cat at"] * 2
    frame(spark, [(k, t, "en", "a") for k, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    p = lattice_lm.Pieces(P.path("piece_bpe_32k.model"))
    place = {n: k for k, n in enumerate(p.names)}
    tokens = {k: (t or "").encode().lower().split() for k, t in enumerate(texts)}
    train = collections.Counter(w for k, ws in tokens.items() if fold(k, 5) != 1 for w in ws)
    ends = sum(fold(k, 5) != 1 for k in tokens)

    def cuts(s):
        if not s:
            yield []
        for n in range(1, len(s) + 1):
            if s[:n] in place:
                yield from ([place[s[:n]], *rest] for rest in cuts(s[n:]))

    logp, before = p.first, -math.inf
    for _ in range(lattice_lm.PASSES):
        used, gained = np.zeros(len(p.names)), 0.0
        for w, c in train.items():
            ways = [(x, math.exp(logp[x].sum())) for x in map(np.array, cuts(b" " + w))]
            total = sum(v for _, v in ways)
            gained += c * math.log(total)
            for x, v in ways:
                np.add.at(used, x, c * v / total)
        whole = used.sum() + ends + lattice_lm.PRIOR * (len(used) + 1)
        logp, log_end = np.log((used + lattice_lm.PRIOR) / whole), math.log((ends + lattice_lm.PRIOR) / whole)
        if gained / sum(train.values()) - before < lattice_lm.STALLED:
            break
        before = gained / sum(train.values())
    score = lambda w: math.log(sum(math.exp(logp[np.array(x)].sum()) for x in cuts(b" " + w)))
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_lattice_lm"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for k, ws in tokens.items():
        assert math.isclose(got[k], (sum(map(score, ws)) + log_end) / math.log(10), rel_tol=1e-9)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    """No documents: every stage gives an empty table with its columns."""
    frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
