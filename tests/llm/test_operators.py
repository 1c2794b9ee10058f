"""Every operator against a brute-force version, on rows with nulls, ties, repeats and very long texts."""

import collections
import hashlib
import math
import os
import random
import struct
import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from roadtally.llm import byte_bpe, components, exact_dedup, lang_id, lattice_lm, mixing, quality_rules, sharding, simhash, suffix_dedup, token_store
from roadtally.llm.common import fresh_path

from .data import base_rows, empty, frame

SPACES = " \t\n\x0b\x0c\r"
ROWS = base_rows()
KEY = lambda r: tuple((v is None, v if v is not None else 0) for v in r)


def strip(text):
    return "".join(c for c in text or "" if c not in SPACES)


def words(text):
    return (text or "").encode().split()


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


# exact dedup


def exact_expected():
    groups = collections.defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[strip(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, members in groups.items():
        members.sort()
        for n, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), n == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=KEY)


@pytest.mark.parametrize("hash_fn", [exact_dedup.content_hash, lambda norm: F.unhex(F.hex(F.length(norm) % 3))])
def test_exact(spark, hash_fn):
    """The second hash collides all the time: bytes decide."""
    got = exact_dedup.exact_classes(frame(spark), hash_fn=hash_fn).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=KEY) == exact_expected()


def test_exact_keeps_rows(spark):
    docs = frame(spark)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(strip(r["text"]) for r in kept.collect()) == dict.fromkeys({strip(r[1]) for r in ROWS}, 1)


# simhash


def shingle_bits(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def connected(fps):
    todo, found = set(fps), []
    while todo:
        group, front = set(), [todo.pop()]
        while front:
            x = front.pop()
            group.add(x)
            near = {y for y in todo if (x ^ y).bit_count() <= 2}
            todo -= near
            front += near
        found.append(group)
    return found


@pytest.mark.parametrize("hot", [200_000, 2])
def test_simhash(spark, hot):
    got = simhash.near_components(frame(spark), hot=hot).select("doc_id", "fingerprint", "component_id").collect()
    fps = [(r[0], shingle_bits(r[1])) for r in ROWS]
    expected = []
    for group in connected({f for _, f in fps}):
        ids = [i for i, f in fps if f in group]
        least = min((i for i in ids if i is not None), default=None)
        expected += [(i, f"{f:016x}", least) for i, f in fps if f in group]
    assert sorted(map(tuple, got), key=KEY) == sorted(expected, key=KEY)


def test_gray_index_finds_all_pairs():
    random.seed(5)
    centres = [random.getrandbits(64) for _ in range(60)]
    values = np.unique(np.array([c ^ sum(1 << b for b in random.sample(range(64), random.randrange(4))) for c in centres for _ in range(30)] + [0, 2**64 - 1], np.uint64))
    index = simhash.GrayIndex(values)
    got = {(int(index.values[i]), int(index.values[j])) for a, b in index.pairs(2) for i, j in zip(a, b)}
    got = {tuple(sorted(p)) for p in got}
    v = values.tolist()
    assert got == {(x, y) for k, x in enumerate(v) for y in v[k + 1 :] if (x ^ y).bit_count() <= 2}


@pytest.mark.parametrize("hot", [200_000, 5])
def test_links_connect_crowded_fingerprints(spark, hot):
    random.seed(6)
    base = random.getrandbits(64)
    values = sorted({base ^ sum(1 << b for b in random.sample(range(64), k)) for k in (0, 1, 1, 2, 3, 4, 5) for _ in range(40)})
    signed = [int(np.uint64(x).astype(np.int64)) for x in values]
    found = components.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), hot)).collect()
    label = {r["node"]: r["component"] for r in found}
    for group in connected(set(values)):
        labels = {label.get(s, s) for s in (int(np.uint64(x).astype(np.int64)) for x in group)}
        assert len(labels) == 1


def test_components_of_a_chain(spark):
    e = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert {got[k] for k in range(301)} == {0} and got[1001] == 1000


def test_near_dedup_keeps_one_of_each(spark):
    kept = simhash.near_dedup(frame(spark))
    left = [shingle_bits(r["text"]) for r in kept.collect()]
    assert len(left) == len(connected({shingle_bits(r[1]) for r in ROWS})) and kept.columns == frame(spark).columns


# language model


def test_lattice_sums_all_segmentations():
    p = lattice_lm.Pieces(P.path("piece_bpe_32k.model"))
    place = {n: k for k, n in enumerate(p.names)}
    lattice = lattice_lm.Lattice(p, p.first)

    def total(s):
        return 1.0 if not s else sum(math.exp(p.first[place[s[:k]]]) * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in place)

    some = [b"the", "niño".encode(), b"a-1", b"road"]
    assert np.allclose(np.exp(lattice.score(some)), [total(b" " + w) for w in some], rtol=1e-9)
    used, gained = lattice.expect(some, np.array([1.0, 2.0, 3.0, 4.0]))
    assert math.isclose(gained, lattice.score(some) @ np.array([1.0, 2.0, 3.0, 4.0]), rel_tol=1e-9)
    assert abs(sum(len(p.names[k]) * used[k] for k in np.flatnonzero(used)) - sum(c * (len(w) + 1) for c, w in zip([1, 2, 3, 4], some))) < 1e-6
    assert np.isfinite(lattice.score([b"\xff\xfe", b"x" * 3000])).all()


@pytest.mark.parametrize("common", [200_000, 3])
def test_language_model(spark, common):
    got = lattice_lm.score(frame(spark), P.path("piece_bpe_32k.model"), broadcast_words=common).collect()
    toks = [(r[0], (r[1] or "").encode().lower().split() + [b""]) for r in ROWS]
    c = collections.Counter(t for i, ts in toks if fold(i, 5) != 1 for t in ts)
    n, v = sum(c.values()), len(c)
    expected = [(i, fold(i, 5) == 1, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)) for i, ts in toks]
    order = lambda r: (*KEY(r[:5]), round(r[5], 3))
    got = sorted(map(tuple, got), key=order)
    for g, e in zip(got, sorted(expected, key=order), strict=True):
        assert g[:5] == e[:5] and abs(g[5] - e[5]) <= 1e-9 * abs(e[5]) and g[6] < 0


# repeated passages


def repeats_expected(rows):
    first = {}
    for doc_id, text, *_ in rows:
        b = (text or "").encode()
        for p in range(len(b) - 49):
            s, k = b[p : p + 50], (doc_id is None, doc_id or 0)
            first[s] = min(first.get(s, k), k)
    out = []
    for doc_id, text, *_ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (doc_id is None, doc_id or 0):
                gone[p : p + 50] = True
        spans = int(gone[:1].sum()) + int((~gone[:-1] & gone[1:]).sum())
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=KEY)


def test_repeats(spark):
    got = suffix_dedup.remove_repeats(frame(spark), keep_bytes=False).collect()
    assert sorted(map(tuple, got), key=KEY) == repeats_expected(ROWS)


def test_repeats_of_few_letters(spark, monkeypatch):
    """Texts over two letters repeat at every length; units are made very small."""
    monkeypatch.setattr(suffix_dedup, "UNIT", 500)
    random.seed(2)
    rows = [(k, "".join(random.choice("ab ") for _ in range(30)) * random.randrange(1, 9), "en", "a") for k in range(25)]
    rows += [(100 + k, rows[k][1][3:150] + "é" + rows[k + 1][1], "en", "a") for k in range(20)]
    got = suffix_dedup.remove_repeats(frame(spark, rows), keep_bytes=False).collect()
    assert sorted(map(tuple, got), key=KEY) == repeats_expected(rows)


def test_segments_see_what_whole_texts_see(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 97)
    text = " ".join(f"w{k * 7919 % 1000}" for k in range(300)).encode()
    seen = []
    for block in suffix_dedup._blocks(pd.DataFrame({"doc": [1, 2], "text": [text, b"short"]})):
        places = suffix_dedup._spread(block.first, block.last)
        part = np.searchsorted(block.start, places, "right") - 1
        seen += (places - block.start[part] + block.base[part]).tolist()
    assert sorted(seen) == list(range(len(text) - 49))


def test_ranks_of_equal_bytes_are_equal():
    """Pairs of ranks name 40 and 50 bytes wherever they stand."""
    random.seed(4)
    text = bytes(random.choice(b"ab") for _ in range(4000)) + b"x" * 60
    block = suffix_dedup.Block([(0, 0, text), (1, 0, text[7:300])], np.array([1, 2]))
    places = suffix_dedup._spread(block.first, block.last)
    for found, n in ((block.gram[places], 20), (block.rank40(places), 40), (block.rank50(places), 50)):
        whole = collections.defaultdict(set)
        for k, name in zip(places.tolist(), found.tolist()):
            whole[block.data[k : k + n]].add(name)
        assert all(len(v) == 1 for v in whole.values()) and len({min(v) for v in whole.values()}) == len(whole)


def test_repeats_leave_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    suffix_dedup.remove_repeats(frame(spark)).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_repeats_leave_nothing_behind_when_they_fail(spark, monkeypatch):
    """The texts lie below the shared folder, never in the warehouse, and go with their table."""
    paths, fresh = [], suffix_dedup.fresh_path
    monkeypatch.setattr(suffix_dedup, "fresh_path", lambda spark, name: paths.append(fresh(spark, name)) or paths[-1])
    monkeypatch.setattr(suffix_dedup, "_without_repeats", lambda spark, texts, keep: 1 / (0 if texts.count() and os.listdir(paths[0].removeprefix("file:")) else 1))
    with pytest.raises(ZeroDivisionError):
        suffix_dedup.remove_repeats(frame(spark))
    assert not os.path.exists(paths[0].removeprefix("file:")) and not [t for t in spark.catalog.listTables() if t.name.startswith("texts_")]
    assert not os.path.exists(warehouse := spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")) or not os.listdir(warehouse)


# token files and byte-pair encoding


@pytest.mark.parametrize("file_bytes", [token_store.FILE_BYTES, 64])
def test_token_files(spark, file_bytes):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    files = token_store.write_tokens(frame(spark), fresh_path(spark, "tokens"), P.path("word_bpe_49k.json"), end_id=1, file_bytes=file_bytes)
    # files grow in number, not in size
    assert (len(files) > int(spark.conf.get("spark.sql.shuffle.partitions"))) == (file_bytes == 64)
    got = token_store.read_tokens(spark, files).orderBy("start").collect()
    start, expected = 0, []
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        data = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((doc_id, start, len(ids), data, zlib.crc32(data)))
        start += len(ids)
    assert [tuple(r) for r in got] == [(a, b, c, d, e) for a, b, c, d, e in expected]


def test_token_reader_opens_only_what_it_needs(tmp_path):
    from pyarrow import fs

    path = str(tmp_path / "x.zst")
    store = fs.LocalFileSystem()
    with store.open_output_stream(path, compression=None) as out:
        w = token_store.Writer(out)
        for k in range(50):
            w.add(k if k else None, struct.pack("<I", k) * 20_000)
        w.close()
    with store.open_input_file(path) as f:
        r = token_store.Reader(f)
        assert len(r.table) > 5 and r.get(30) == [struct.pack("<I", 30) * 20_000] and r.get(None) == [struct.pack("<I", 0) * 20_000] and r.get(99) == []
        assert [i for i, _ in r] == [None, *range(1, 50)]
    data = bytearray(open(path, "rb").read())
    data[int(r.starts[2]) + 40] ^= 1
    open(path, "wb").write(data)
    with store.open_input_file(path) as f, pytest.raises(Exception):  # noqa: B017, PT011
        list(token_store.Reader(f))


@pytest.fixture(scope="module")
def bpe():
    import tiktoken

    encoder = byte_bpe.Encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    return encoder, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def test_bpe_is_the_librarys(bpe):
    encoder, library = bpe
    random.seed(1)
    letters = "ab  \n\n\t\r'sé 　the12,.!$\x1c日🎉  \x85"
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(80))) for _ in range(4000)] + [r[1] or "" for r in ROWS]
    for x in texts:
        ids = encoder.encode(x)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(x)
        assert encoder.decode(ids) == x.encode()


def test_bpe_appends_and_edits(bpe):
    v = bpe[0].vocabulary
    random.seed(4)
    for _ in range(200):
        data = bytes(random.choice(b"etaoin shrd") for _ in range(40))
        grown = byte_bpe.PrefixEncoder(v, data[:15])
        grown.append(data[15:])
        assert grown.last == byte_bpe.PrefixEncoder(v, data).last
        a, b = sorted(random.sample(range(41), 2))
        grown.edit(a, b, b"xyz")
        assert grown.ids() == byte_bpe.PrefixEncoder(v, data[:a] + b"xyz" + data[b:]).ids()
        assert b"".join(v.tokens[t] for t in grown.ids()) == grown.data


def test_bpe_over_spark(spark, bpe):
    path = P.path("byte_bpe_50k.tiktoken")
    docs = frame(spark)
    encoded = byte_bpe.encode_bpe(docs, path, P.PATTERN)
    assert encoded.columns == [*docs.columns, "bpe"]
    back = byte_bpe.decode_bpe(encoded.select("text", F.col("bpe.ids").alias("ids"), "bpe.decoded_sha256"), path).collect()
    assert all(r["decoded"] == (r["text"] or "").encode() and r["decoded_sha256"] == hashlib.sha256(r["decoded"]).hexdigest() for r in back)


# language identification


def test_cross_parsing_counts_longest_matches():
    """Longest matches of whole texts, of one letter to thousands, with letters the sample lacks; short and long ones are parsed apart."""
    letters = "abcdefghijklmnop" + "".join(chr(c) for c in range(0x4E00, 0x4F00))
    table = lang_id.symbol_table("".join(sorted(letters)))
    random.seed(6)
    chinese = "".join(random.choice(letters[16:]) for _ in range(400))
    samples = ["the cat sat on a mat and the dog ate it " * 3, "on a mat the dog can fib " + chinese]
    symbols = [lang_id.symbols_of(x, table) for x in samples]
    model = {"letters": "".join(sorted(letters)), "langs": [(f"x{k}", len(s), lang_id.pack(lang_id.suffix_automaton(s.tolist()), 2 + len(letters))) for k, s in enumerate(symbols)]}

    def phrases(text, sample):
        t, known, n, i = [chr(c) for c in lang_id.symbols_of(text, table)], "".join(chr(c) for c in sample), 0, 0
        while i < len(t):
            k = 1
            while i + k < len(t) and "".join(t[i : i + k + 1]) in known and t[i] in known:
                k += 1
            n, i = n + 1, i + k
        return n

    texts = ["the cat", "a dog on a mat", "tac eht", "the", "dog dog dog", "the zebra quiz", "zz", "", chinese[50:90], "x"]
    texts += ["".join(random.choice(["the ", "cat ", "dog", " mat", "qu", chinese[20:30], "e", "9 "]) for _ in range(n)) for n in (*range(40), 700, 2000)]
    got = lang_id.Parser(model).phrases([lang_id.symbols_of(t, table) for t in texts]).tolist()
    assert got == [[phrases(t, s) for s in symbols] for t in texts]


def test_languages(spark):
    say = {"en": "the road was counted by the hour and the day", "de": "die Straße wurde jede Stunde und jeden Tag gezählt", "fr": "la route était comptée chaque heure et chaque jour"}
    rows = [(k, (say[lang] + " ") * (1 + k % 4), lang, "a") for k, lang in enumerate(["en", "de", "fr"] * 20)]
    odd = [(100, None, "en", "a"), (101, "12 34 !?", "de", "a"), (102, "", "fr", "a"), (103, say["fr"], None, "a")]
    docs = frame(spark, rows + odd)
    found = {r["doc_id"]: (r["p"]["lang_pred"], r["p"]["score"]) for r in lang_id.identify(docs, docs.where(~lang_id.held_out(F.col("doc_id"))), out_col="p").collect()}
    assert all(found[r[0]][0] == r[2] for r in rows) and found[103][0] == "fr"
    assert [found[k] for k in (100, 101, 102)] == [("und", 0.0)] * 3
    assert all(0 <= s <= 1 for _, s in found.values())


# quality rules


def quality_expected(text):
    w = words(text)
    windows = list(zip(w, w[1:], w[2:]))
    seen, covered = collections.Counter(windows), set()
    for i, g in enumerate(windows):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    rows = [*ROWS, (90, "x\nx\n \n\nx y\nx", "en", "a"), (91, "a b c a b c d #|<", "en", "a"), (92, "the of and %%% " * 40, "en", "a")]
    got = quality_rules.judge(frame(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    expected = [(r[0], *(q := quality_expected(r[1])), q[0] < 50 or 100 * q[4] > 50 * q[0]) for r in rows]
    assert sorted(map(tuple, got), key=KEY) == sorted(expected, key=KEY)


def test_distance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.75, 0.25], [0.25, 0.75])], "p array<double>, q array<double>")
    got = [r[0] for r in df.select(quality_rules.distance(F.col("p"), F.col("q"))).collect()]
    js = sum(0.5 * x * math.log2(2 * x / (x + y)) + 0.5 * y * math.log2(2 * y / (x + y)) for x, y in [(0.75, 0.25), (0.25, 0.75)])
    assert np.allclose(got, [1, 0, math.sqrt(js)])


def kept_expected(rows, bins, spread):
    """The verdicts by the documented rules, with Python's own counting."""
    import regex

    def classes(t):
        counts = [sum(len(x) for x in regex.findall(c, t)) for c in quality_rules.CLASSES]
        return [n / max(len(t), 1) for n in [*counts, len(t) - sum(counts)]]

    def js(p, q):
        part = lambda x, y: x * math.log2(2 * x / (x + y)) if x > 0 else 0.0
        return math.sqrt(max(0.0, sum((part(x, y) + part(y, x)) / 2 for x, y in zip(p, q))))

    plain = lambda w: w.decode().rstrip(".,;:!?").lower()
    count = collections.defaultdict(collections.Counter)
    for _, t, lang, _ in rows:
        if lang is not None:
            count[lang].update(map(plain, words(t)))
    total = {x: sum(len(words(t)) for _, t, y, _ in rows if y == x) for x in count}
    common = sorted({w for x, c in count.items() for n, w in sorted((-n, w) for w, n in c.items() if w and n * 1000 >= total[x])[:bins]})

    def shares(t):
        c, n = collections.Counter(map(plain, words(t))), max(len(words(t)), 1)
        own = [c[w] / n for w in common]
        return [*own, max(0.0, 1 - sum(own))]

    features = [(classes(t or ""), shares(t)) for _, t, _, _ in rows]
    long = [len(words(t)) >= 50 and len(t or "") >= 200 for _, t, _, _ in rows]
    langs = sorted({r[2] for r, x in zip(rows, long) if x and r[2] is not None})
    own = {x: [f for f, r, y in zip(features, rows, long) if y and r[2] == x] for x in langs}
    refs = {x: [np.mean([f[k] for f in own[x]], axis=0).tolist() for k in (0, 1)] for x in langs}
    most = {x: [spread * sorted(js(f[k], refs[x][k]) for f in own[x])[(len(own[x]) + 1) // 2 - 1] for k in (0, 1)] for x in langs}
    near = lambda f, k: any(js(f[k], refs[x][k]) <= most[x][k] + 1e-12 for x in langs) or not langs
    out = []
    for (doc_id, t, _, _), f in zip(rows, features):
        q = quality_expected(t)
        failed = q[0] < 50 or 100 * q[4] > 50 * q[0]
        out.append((doc_id, not failed and not (len(t or "") >= 200 and not near(f, 0)) and not (q[0] >= 50 and not near(f, 1))))
    return out


def test_verdicts(spark):
    """Two languages, soup among them, equal rows and null ids, against the documented rules."""
    random.seed(9)
    say = lambda ws, n: " ".join(random.choice(ws) + random.choice(["", "", ","]) + str(random.randrange(99) if random.random() < 0.1 else "") for _ in range(n))
    en, de = "the of and road counted hour night in to light Every day".split(), "der die und Straße gezählt Stunde Nacht in zu Licht Jeder Tag".split()
    rows = [(k, say(en if k % 2 else de, 60 + k), "en" if k % 2 else "de", "a") for k in range(40)]
    rows += [(100 + k, " ".join(f"x{random.random()}{'#$%&'[k % 4] * 3}" for _ in range(80)), "en", "a") for k in range(5)] + [rows[3], rows[3], (None, rows[5][1], None, "a"), (None, None, "en", "a")]
    for bins, spread in ((quality_rules.BINS, quality_rules.SPREAD), (3, 1.05)):
        got = quality_rules.judge(frame(spark, rows), bins=bins, spread=spread).select("doc_id", "kept").collect()
        expected = kept_expected(rows, bins, spread)
        assert sorted(map(tuple, got), key=KEY) == sorted(expected, key=KEY)
        assert {k for _, k in expected} == {True, False}


def test_symbol_soup_is_not_kept(spark):
    random.seed(8)
    clean = [(k, " ".join(random.choice(["the", "of", "and", "road", "counted", "hour", "night", "in", "to", "light"]) + str(random.choice(["", ",", "."])) for _ in range(120)), "en", "a") for k in range(30)]
    soup = [(100, " ".join(f"x{k}{'#$%&'[k % 4] * 3}" for k in range(100)), "en", "a")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(frame(spark, clean + soup)).collect()}
    assert all(got[r[0]] for r in clean) and not got[100]


# sharding


def test_sharding(spark):
    docs = frame(spark)
    got = sharding.shard(docs, shards=5).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == sorted((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in ROWS if r[0] is not None)
    assert len(got) == len(ROWS) and {r["law"] for r in got} == {"bytes"}
    for s in range(5):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_are_near_equal(spark):
    rows = [(k, f"text {k} " * (1 + k % 20), "en", "a") for k in range(1500)] + [(5000 + k, "the same again " * 10, "en", "a") for k in range(700)]
    got = sharding.shard(frame(spark, rows), shards=8).collect()
    total = collections.Counter()
    for r in got:
        total[r["shard"]] += r["size"]
    most = max(r["size"] for r in got)
    # the largest document, and the group that a boundary can fall on
    assert max(total.values()) - min(total.values()) <= most + sum(total.values()) / 8 / 50
    again = sharding.shard(frame(spark, rows), shards=8).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in again)


@pytest.mark.parametrize("shards", [2, 7])
def test_shards_of_single_texts_differ_by_a_document(spark, shards):
    """No equal texts: every boundary falls on a row; keys follow a brute-force order of the same key."""
    random.seed(shards)
    rows = [(k, "x" * random.choice([3, 40, 700]) + str(k), "en", "a") for k in range(900)]
    got = sharding.shard(frame(spark, rows), shards=shards).collect()
    total, size = collections.Counter(), {r["doc_id"]: r["size"] for r in got}
    key = {r["doc_id"]: r["key"] for r in sharding.sized(frame(spark, rows)).collect()}
    whole, at, expected = sum(size.values()), 0, {}
    for doc_id in sorted(key, key=key.get):
        expected[doc_id] = int((at + size[doc_id] / 2) * shards / whole)
        at += size[doc_id]
    assert {r["doc_id"]: r["shard"] for r in got} == expected
    for r in got:
        total[r["shard"]] += r["size"]
    # half a document at each end
    assert all(abs(n - whole / shards) <= max(size.values()) for n in total.values())
    slots = {s: [d for d in sorted(key, key=key.get) if expected[d] == s] for s in range(shards)}
    assert all(slots[r["shard"]][r["slot"]] == r["doc_id"] for r in got)


def test_hot_keys_and_large_rows_end(spark):
    """A third of all rows is one row repeated, another text outweighs the rest, ids are null: ranges are cut until only single keys are overfull."""
    rows = [(7, "hot " * 50, "en", "a")] * 300 + [(None, "null hot " * 20, "en", "a")] * 200 + [(k, "y" * 300_000 if k == 50 else f"text {k}", "en", "a") for k in range(400)]
    got = sharding.shard(frame(spark, rows), shards=4).collect()
    assert len(got) == len(rows)
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


# mixing


def test_targets():
    assert mixing.targets([]) == []
    t = mixing.targets([("b", 100), ("a", 10), (None, 1000)])
    assert [x[0] for x in t] == ["a", "b", None] and t[0][2] == 30 and t[1][2] == 300 and abs(t[2][2] - 780) < 1e-9
    assert [x[2] for x in mixing.targets([("a", 0), ("b", 5)])] == [0, 5]


def test_position_inverts_the_demand(spark):
    df = spark.range(101).select((F.col("id") / 100.0).alias("t"), F.explode(F.array(*[F.lit(s) for s in (-0.8, 0.0, 0.5, 0.8)])).alias("a"))
    x = 200.0 * (F.col("t") + F.col("a") * (F.col("t") * F.col("t") - F.col("t")))
    assert df.select(F.max(F.abs(mixing.position(x, F.lit(200.0), F.col("a")) - F.col("t")))).first()[0] < 1e-9


@pytest.mark.parametrize("bucket_rows", [mixing.BUCKET_ROWS, 0.1])
def test_mixing(spark, monkeypatch, bucket_rows):
    """With many rows there are more buckets than 256; the targets are met as well."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rows = ROWS + [(1000 + k, " ".join(["w"] * (1 + k * 7 % 90)), "en", "abcd"[k % 4] if k % 9 else None) for k in range(400)]
    got = mixing.mix(frame(spark, rows)).collect()
    plan = {s: (n, t) for s, n, t in mixing.targets([(s, sum(len(words(r[1])) for r in rows if r[3] == s)) for s in {r[3] for r in rows}])}
    taken = collections.Counter()
    for r in got:
        n, t = plan[r["source"]]
        assert r["source_size"] == n and abs(r["target"] - t) < 1e-6 and r["taken"] <= 3 * r["size"] and len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        taken[r["source"]] += r["taken"]
    largest = {s: max(len(words(r[1])) for r in rows if r[3] == s) for s in plan}
    # no choice of whole documents comes near where one of them outweighs the last pass
    assert len(got) == len(rows) and all(abs(taken[s] - t) <= max(20, 0.02 * t) or largest[s] > t % n for s, (n, t) in plan.items())
    shown = [r["first_position"] for r in got]
    known = [p for p in shown if p is not None]
    assert known == sorted(known)


def test_mixing_fills_targets_as_far_as_documents_fit(spark):
    """Sources of small documents and few large ones: none that still fits is left over."""
    rows = [(k, " ".join(["w"] * (400 if k % 40 < 4 else 1 + k * 7 % 23)), "en", "abcdefgh"[k % 8]) for k in range(640)]
    per = collections.defaultdict(list)
    for r in mixing.mix(frame(spark, rows)).collect():
        per[r["source"]].append(r)
    for own in per.values():
        n, t = own[0]["source_size"], own[0]["target"]
        gap, passes = t - sum(r["taken"] for r in own), int(t // n)
        assert all(passes <= r["copies"] <= passes + 1 for r in own)
        assert passes == 3 or not [r for r in own if r["copies"] == passes and 0 < r["size"] <= gap]
        # each copy has a place of its own, those of the last pass too
        places = [p for r in own if r["size"] for p in r["positions"]]
        assert len(set(places)) >= len(places) - 1 and max(places) <= 1


def test_training_order(spark):
    docs = frame(spark, [r for r in ROWS if r[0] is not None])
    out = mixing.training_order(docs)
    n = {(r["doc_id"], r["h"]): r["copies"] for r in mixing.mix(docs).collect()}
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in mixing.mix(docs).collect()) and n


# empty tables


def test_empty_tables(spark):
    docs, model = empty(spark), P.path("piece_bpe_32k.model")
    for made in (
        exact_dedup.exact_classes(docs), exact_dedup.exact_dedup(docs), simhash.near_components(docs), simhash.near_dedup(docs), lattice_lm.score(docs, model), suffix_dedup.remove_repeats(docs),
        byte_bpe.encode_bpe(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), lang_id.identify(docs, docs), quality_rules.judge(docs), sharding.shard(docs), mixing.mix(docs), mixing.training_order(docs),
        token_store.read_tokens(spark, token_store.write_tokens(docs, fresh_path(spark, "tokens"), P.path("word_bpe_49k.json"), 1)),
    ):
        assert made.count() == 0
