"""The pipeline's stages against brute force, each on its own input."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from roadtally.llm import near_copies
from roadtally.llm.byte_bpe import load_ranks

from .data import base_rows, frame
from .test_operators import connected, shingle_bits, strip, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    rows = [r for r in base_rows() if r[0] is not None]
    docs = frame(spark, rows).select(*COLUMNS)
    (_, language), (_, exact), (_, near), (_, mixed), (_, encode) = corpus_pipeline.STAGES

    kept = language(spark, docs, "")
    assert kept.columns == COLUMNS
    texts = collections.Counter(r["text"] for r in kept.collect())
    assert texts == collections.Counter(r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1]))

    once = exact(spark, kept, "")
    assert once.columns == COLUMNS
    assert collections.Counter(strip(r["text"]) for r in once.collect()) == dict.fromkeys({strip(t) for t in texts}, 1)

    apart = near(spark, once, "").collect()
    groups = connected({shingle_bits(r["text"]) for r in once.collect()})
    ids = [(r["doc_id"], shingle_bits(r["text"])) for r in once.collect()]
    assert sorted(r["doc_id"] for r in apart) == sorted(min(i for i, f in ids if f in g) for g in groups)

    order = mixed(spark, near(spark, once, ""), "")
    copies = collections.Counter(r["doc_id"] for r in order.collect())
    assert order.columns == COLUMNS and max(copies.values()) <= 3 and set(copies) <= {r["doc_id"] for r in apart}
    size = collections.Counter()
    for r in apart:
        size[r["source"]] += len(words(r["text"]))
    assert sum(len(words(r["text"])) for r in order.collect()) <= 3 * sum(size.values())

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    source = {r["doc_id"]: r["text"] for r in apart}
    for r in encode(spark, order, "").collect():
        ids = np.array(library.encode_ordinary(source[r["doc_id"]]), "<u4").tobytes()
        assert r["ids"] == ids and r["ids_sha256"] == hashlib.sha256(ids).hexdigest() and r["decoded_sha256"] == hashlib.sha256(source[r["doc_id"]].encode()).hexdigest()


def test_run(spark, tmp_path):
    frame(spark, [r for r in base_rows() if r[0] is not None]).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def five(text):
    w = text.lower().encode().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def grouped(texts):
    """Smallest place reachable by similarities of 0.8, for each text."""
    sets, group = [five(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = [lo if g == hi else g for g in group]
    return group


def test_near_copies_of_one_text_around_the_limit(spark):
    """One text, each copy changed in its own way, some copies of copies that share their changes."""
    draw = random.Random(8)
    first = [f"w{draw.randrange(300)}" for _ in range(150)]
    texts = []
    for k in range(160):
        words = (draw.choice(texts).split() if texts and k % 5 == 0 else list(first))
        for _ in range(draw.randrange(1, 3) if k % 5 == 0 else draw.randrange(1, 12)):
            words[draw.randrange(150)] = f"n{draw.randrange(6)}"
        texts.append(" ".join(words))
    group = grouped(texts)
    assert 20 < len(set(group)) < 140
    for rare in (near_copies.RARE, 50):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(near_copies, "RARE", rare)
            got = near_copies.near_components(frame(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])).select("doc_id", "component").collect()
        least = {}
        for r in got:
            least[r["component"]] = min(r["doc_id"], least.get(r["component"], r["doc_id"]))
        assert [least[r["component"]] for r in sorted(got)] == group


def test_near_copies_are_those_of_five_words_and_similarity_08(spark):
    """Copies with some words changed, on both sides of 0.8; most are far more than two bits of a fingerprint apart."""
    draw = random.Random(5)
    say = lambda n: [f"w{draw.randrange(500)}" for _ in range(n)]
    texts = [" ".join(say(n)) for n in (1, 3, 5, 5, 6)]
    for n in (30, 60, 120, 400):
        for _ in range(12):
            kept = say(n)
            texts.append(" ".join(kept))
            for _ in range(3):
                kept = list(kept)
                for _ in range(draw.randrange(1, 1 + n // 30)) if n > 30 else (0,):
                    kept[draw.randrange(n)] = "new"
                texts.append(" ".join(kept))
    group = grouped(texts)
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, rows).select(*COLUMNS), "")
    assert 5 < len(texts) - len(set(group)) < len(texts) - 20
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(group))


def test_texts_without_any_label_stay(spark):
    rows = [(k, t, None, "a") for k, t in enumerate(["one text", "Straße", "日本語", "12 34 !!", "", None])]
    kept = corpus_pipeline.identify_language(spark, frame(spark, rows).select(*COLUMNS), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]


def test_near_copies_come_from_tables_of_fingerprints(spark):
    """With small buckets, texts meet by parts of their fingerprints only; crowded ones are one cluster around a text."""
    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(400)}" for _ in range(80)) for _ in range(120)]
    for k in range(0, 120, 3):
        words = texts[k].split()
        words[draw.randrange(80)] = "new"
        texts.append(" ".join(words))
    one = texts[0].split()
    texts += [" ".join(one[:k] + [f"n{k}"] + one[k + 1 :]) for k in range(5, 75)]
    f = [near_copies.majorities(near_copies.shingles(t), 4) for t in texts]
    assert 10 < np.mean([(f[120 + k] != f[3 * k]).sum() for k in range(40)]) < 40 and 115 < np.mean([(f[k] != f[k + 1]).sum() for k in range(119)]) < 141
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(near_copies, "BUCKET", 8)
        assert near_copies.shape(len(texts)) == (5, 16)
        got = near_copies.near_components(frame(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])).select("doc_id", "component").collect()
    least = {}
    for r in got:
        least[r["component"]] = min(r["doc_id"], least.get(r["component"], r["doc_id"]))
    assert [least[r["component"]] for r in sorted(got)] == grouped(texts)
    words = np.stack([np.packbits(x).view("<u8") for x in f])
    words = words[np.argsort(near_copies.gray_rank(words[:, 0]), kind="stable")]
    plain = near_copies.forest(len(words), near_copies._links(words))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(near_copies, "CROWD", 60)
        near = words[near_copies._differ(words, words[np.bincount(plain).argmax()]) <= 90]
        root = near_copies.forest(len(near), near_copies._links(near))
    assert len(near) > 60 and len(set(root)) == 1
