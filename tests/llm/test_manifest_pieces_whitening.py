"""Merkle manifests, sentence pieces and whitening against brute force and the library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from roadtally.llm import merkle, piece_bpe, queries, whitening

from ..oracle import spark_rows, sql_rows
from .data import base_rows, empty, frame
from .test_operators import KEY

MODEL = P.path("piece_bpe_32k.model")


# --- Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r):
    return digest(*map(field, r))


def tower(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def manifest_expected(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    trees, out = {}, []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))):
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    towers = {t: tower(list(map(leaf_of, trees[t]))) for t in order}
    top = tower([towers[t][-1][0] for t in order])
    for k, t in enumerate(order):
        for i, r in enumerate(trees[t]):
            text, beside = r[4], []
            if text is not None and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf_of((*r[:4], text))
            for levels, at in ((towers[t], i), (top, k)):
                for level in levels[:-1]:
                    a = at // 8 * 8
                    run = level[a : a + 8]
                    beside += run[: at - a] + run[at - a + 1 :]
                    h = digest(*run[: at - a], h, *run[at - a + 1 :])
                    at //= 8
            out.append((r[0], leaf_of(r), towers[t][-1][0], top[-1][0], digest(*beside), h, h == top[-1][0]))
    return sorted(out, key=KEY)


def manifest_found(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, queries.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=KEY)


def test_addresses_are_a_layout_split_at_half_height():
    for levels in range(1, 6):
        places = [int(p) for d in range(levels) for p in merkle.address(levels, d, np.arange(8**d))]
        assert sorted(places) == list(range(merkle.size(levels)))
    assert merkle.address(4, 0, 0) == 0 and merkle.address(4, 1, 7) == 8  # upper half: a root and its eight children
    assert [merkle.address(4, 2, k) for k in (0, 1, 8)] == [9, 18, 81] and merkle.address(4, 3, 8) == 19  # lower halves, nine nodes each


def test_manifest(spark, tmp_path):
    rows = [(k, source, lang, len(t or ""), t) for k, t, lang, source in base_rows()]
    rows += [(100 + k, None, None, None, f"Text {k}" if k % 5 else None) for k in range(70)]
    assert manifest_found(spark, tmp_path, rows) == manifest_expected(rows)


def test_manifest_of_several_tiers(spark, tmp_path, monkeypatch):
    """Trees of more leaves than one block holds, and more trees than that."""
    rows = [(k, "s", "en", 1, f"A {k}") for k in range(1, 1400)] + [(k, "s", f"l{k}", 1, f"B {k}") for k in range(2000, 2530)] + [(7, "s", "de", 1, "same")] * 600
    assert manifest_found(spark, tmp_path, rows) == manifest_expected(rows)


def test_manifest_of_one_row_and_of_none(spark, tmp_path):
    (found,) = manifest_found(spark, tmp_path / "one", [(5, None, None, None, None)])
    assert found[1] == found[2] == found[3] == found[5] and found[4] == digest() and found[6]
    assert manifest_found(spark, tmp_path / "none", []) == []


def test_manifest_equals_its_sql(spark, tmp_path):
    for sf in ("sf0.001",):
        folder = f"/root/testdata/{sf}"
        assert spark_rows(queries.op11_merkle_manifest(spark, folder)) == sql_rows(queries.SQL["op11_merkle_manifest"], folder)


def test_kept_paths_verify_alone(spark, tmp_path):
    docs = frame(spark, base_rows())
    merkle.build_manifest(docs, f"file://{tmp_path}/m")
    found = merkle.proofs(spark, f"file://{tmp_path}/m", keep_path=True)
    good = merkle.verify_path(F.unhex("leaf"), F.col("path"), F.col("root"))
    bad = merkle.verify_path(F.unhex(F.sha2("leaf", 256)), F.col("path"), F.col("root"))
    assert [tuple(r) for r in found.select(good, bad, "verified").distinct().collect()] == [(True, False, True)]


# --- sentence pieces


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.PieceModel(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_pieces_are_the_librarys(pieces):
    model, library = pieces
    random.seed(3)
    parts = [" ", "▁", "a", "b", "e", "the", "ing", "1", "23", "\n", "\t", "\r", "日", "本", "é", "ﬁ", "𝔘", "\0", "()", "{}", "  ", "    ", "abab", "====", "----", "....", "////", "<s>", "<0x41>", " "]
    texts = ["".join(random.choices(parts, k=random.randrange(60))) for _ in range(4000)] + [c * k for c in " ae=.▁" for k in range(70)] + [t or "" for _, t, *_ in base_rows()]
    found = model.encode(texts)
    assert list(map(ids_of, found)) == library.encode(texts, add_bos=True, add_eos=True)
    assert [model.decode(i) for i in found] == library.decode(list(map(ids_of, found)))


def test_pieces_without_the_table_of_words(pieces):
    """The rounds themselves, on whole batches of words, and the plain rule."""
    model, library = pieces
    random.seed(4)
    words = ["▁" * random.randrange(3) + "".join(random.choices("abcdeinorst()=é日", k=random.randrange(1, 40))) for _ in range(3000)]
    plain = lambda w: [s for _, s in model.queue([int(model.symbols[ord(c)]) for c in w])]
    for w, data in zip(words, model.encode_words(words)):
        spelt = [i for s in plain(w) for i in ([s] if s < model.size else [int(model.bytes[b]) for b in chr(s - model.size).encode()])]
        assert ids_of(data) == spelt


def test_broken_ids_decode_as_the_library_does(pieces):
    model, library = pieces
    random.seed(5)
    lists = [[random.choice([random.randrange(model.size), random.randrange(300), 28705, 259, 0, 1, 2]) for _ in range(random.randrange(12))] for _ in range(4000)]
    assert [model.decode(np.array(x, "<u4").tobytes()) for x in lists] == [library.decode(x) for x in lists]


@pytest.mark.parametrize("make", [lambda n: "ab cd\n" * (n // 6), lambda n: "a" * n, lambda n: "日" * n], ids=["words", "letters", "bytes"])
def test_pieces_of_a_very_long_text(pieces, make):
    model, library = pieces
    text = make(3_000_000)
    assert ids_of(model.encode([text])[0]) == library.encode(text, add_bos=True, add_eos=True)


def test_a_run_of_spaces_is_finished_by_the_queue(pieces):
    model, library = pieces
    text = "x" + " " * 50_000 + "y"
    assert ids_of(model.encode([text])[0]) == library.encode(text, add_bos=True, add_eos=True)


def test_pieces_over_spark(spark, pieces):
    docs = frame(spark)
    out = piece_bpe.decode_pieces(piece_bpe.encode_pieces(docs, MODEL).select("*", "pieces.ids"), MODEL)
    assert set(docs.columns) < set(out.columns) and out.count() == len(base_rows())
    for r in out.collect():
        expected = pieces[1].encode(r["text"] or "", add_bos=True, add_eos=True)
        assert ids_of(r["ids"]) == expected and r["pieces"]["n_tokens"] == len(expected) and r["decoded"] == pieces[1].decode(expected)
        assert r["pieces"]["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert piece_bpe.encode_pieces(empty(spark), MODEL).collect() == []


# --- whitening


def spectra(rng, d):
    return [rng.random(d), np.ones(d), 10.0 ** rng.integers(-8, 8, d), np.r_[np.ones(d // 2), np.zeros(d - d // 2)], 1 + 1e-9 * rng.random(d)]


@pytest.mark.parametrize("d", [1, 2, 5, 17, 40])
def test_contours_find_every_eigenvalue(d):
    rng = np.random.default_rng(d)
    for spectrum in spectra(rng, d):
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        v = (q * spectrum) @ q.T
        v = (v + v.T) / 2
        for shift in rng.random(5):
            assert whitening.negatives(v - shift * np.eye(d)) == (np.linalg.eigvalsh(v) < shift).sum()
        for k in {1, min(4, d), d}:
            found = [whitening.feast(v, *p) for p in whitening.intervals(v, k)]
            values = np.sort(np.concatenate([np.zeros(0), *[f[0] for f in found]]))[::-1][:k]
            expected = np.sort(np.linalg.eigvalsh(v))[::-1]
            expected = expected[expected > whitening.LEAST * np.trace(v)][:k]
            assert len(values) == len(expected) and np.allclose(values, expected, rtol=0, atol=1e-12 * np.trace(v))
            for e, u in found:
                assert np.allclose(v @ u, u * e, rtol=0, atol=1e-12 * np.trace(v)) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)


def whitening_expected(rows, k):
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max(len(x) for _, x in kept)
    kept = [(i, x + [0] * (d - len(x))) for i, x in kept]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), [sum(int(x[j]) for x in fit) for j in range(d)]
    centred = fit - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    share = values[::-1] / values.sum()
    out = {}
    for i, x in kept:
        for c in range(k):
            out[i, c + 1] = (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), abs((np.array(x) - np.array(sums) / n) @ vectors[:, -1 - c]) / np.sqrt(values[-1 - c]), share[c])
    return out


def check_whitening(spark, rows, k=4):
    df = spark.createDataFrame([(i, v, 1.0, "s") for i, v in rows], "vec_id long, embedding array<float>, whitened double, x string").repartition(3)
    found = whitening.whiten(df, components=k).collect()
    expected = whitening_expected(rows, k)
    assert len(found) == len(expected) and {(r.vec_id, r.component) for r in found} == set(expected)
    for r in found:
        n, deviation, white, share = expected[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and abs(abs(r.whitened) - white) < 1e-8 and abs(r.explained - share) <= 1e-4 * share
        assert r.identity_error <= 1e-4 and r.identity_error == found[0].identity_error
    return found


def test_whitening(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(c) for c in np.float32(rng.standard_normal(12) * np.arange(1, 13))]) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # copies count once
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (2004, [0.5, -0.25])]
    found = check_whitening(spark, rows)
    signs = {r.component: np.sign(r.whitened) for r in found if r.vec_id == 0}
    assert all(np.sign(r.whitened) == signs[r.component] for r in found if r.vec_id >= 1000 and r.vec_id < 2000)


def test_whitening_of_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(c) for c in rng.random(2)]) for k in range(50)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 4).collect()} == {1, 2}


def test_whitening_of_large_numbers(spark):
    """Sums and deviations beyond a long."""
    rows = [(k, [3e17 * (k % 7 - 3), 2.0**60 * (k % 3), float(k)]) for k in range(40)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1).collect()
    assert len(found) == 40 and {r.deviation for r in found} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(None, [])]], ids=["none", "nulls", "equal", "no dimension"])
def test_whitening_without_components(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 4)
    assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_moments_merge(spark):
    x = np.random.default_rng(3).standard_normal((90, 5)) + 100
    merged = whitening.Moments.of(x[:20]).merge(whitening.Moments.of(x[20:21])).merge(whitening.Moments.of(x[21:]))
    assert merged.n == 90 and np.allclose(merged.mean, x.mean(0)) and np.allclose(merged.products / 90, np.cov(x.T, bias=True))


# --- edits of byte pairs


def test_edits_near_and_far(spark):
    """Any edit gives what encoding anew gives; one at the front of a long text costs a small part of that."""
    import time

    from roadtally.llm import byte_bpe

    v = byte_bpe.Vocabulary(byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")))
    random.seed(6)
    text = lambda n: "".join(random.choice(["the ", "count", "ing", " ", "  ", "aaaa", "é", "日本", "12", "xyz"]) for _ in range(n)).encode()
    for _ in range(300):
        e = byte_bpe.PrefixEncoder(v, text(random.randrange(120)))
        for _ in range(3):
            a = random.randrange(len(e.data) + 1)
            b = random.randrange(a, min(len(e.data), a + 40) + 1)
            e.edit(a, b, text(random.randrange(6)))
            assert e.last == byte_bpe.PrefixEncoder(v, e.data).last
    data = text(80_000)
    began = time.perf_counter()
    e = byte_bpe.PrefixEncoder(v, data)
    whole, began = time.perf_counter() - began, time.perf_counter()
    e.edit(10, 11, b"road")
    assert time.perf_counter() - began < whole / 5 and e.data == data[:10] + b"road" + data[11:]
    assert e.last == byte_bpe.PrefixEncoder(v, e.data).last
