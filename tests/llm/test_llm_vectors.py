"""Shards of ids, inner products, the classifier, fingerprints and SimHash against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_path import cases
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import components, inner_product, multiset_hash, quality_mil, repair, simhash

# --- shards of ids ----------------------------------------------------------------------

_WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(_WORDS)


def test_shards_hold_the_ids(spark, tokenizer):
    rows = cases.awkward() + [cases.row(300 + i, t) for i, t in enumerate(["<|endoftext|> x<|startoftext|>y", "a²b½ it's THEY'LL 1234"])]
    docs = cases.frame(spark, rows)
    path = repair.write(docs, _WORDS)
    expected = {}
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected.setdefault(doc_id, []).append(ids)
    got = {}
    for r in repair.read(spark, path).collect():
        got.setdefault(r.doc_id, []).append(list(r.ids))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    found = repair.checked(spark, path).orderBy("start").collect()
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
        crcs = [zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in expected[r.doc_id]]
        assert r.ids_crc32 in crcs
    ids_in_order = [r.doc_id for r in found]
    known = [i for i in ids_in_order if i is not None]
    assert known == sorted(known) and ids_in_order[: len(known)] == known
    assert repair.checked(spark, repair.write(cases.frame(spark, []), _WORDS)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_words_are_encoded_as_texts(tokenizer, texts):
    ids, ends = repair.load(_WORDS, 1).encode(texts)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert ids.tolist() == [i for part in expected for i in part]
    assert ends.tolist() == np.cumsum([len(e) for e in expected]).tolist()


def test_every_character_in_a_word(tokenizer):
    encoder = repair.load(_WORDS, 1)
    for c in range(0x21, 0x3100):
        for text in (chr(c) + "a", "Ab" + chr(c) + "."):
            assert encoder.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], hex(c)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=200), st.integers(1, 8))
def test_any_ids_come_back(ids, rounds):
    seq, rules = repair.compress(np.array(ids, np.uint16), 6, 1, rounds=rounds, least=2)
    assert repair.Grammar(rules, 6).expand(seq).tolist() == ids
    assert not (rules == 1).any()


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(7)
    copies = np.concatenate([np.append(rng.integers(2, 50, 3000), 1)] * 300)
    seq, rules = repair.compress(copies, 100, 1)
    assert repair.Grammar(rules, 100).expand(seq).tolist() == copies.tolist()
    pairs = [p for p in zip(seq[:-1].tolist(), seq[1:].tolist(), strict=True) if 1 not in p]
    assert max((pairs.count(p) for p in set(pairs)), default=0) < 4
    assert len(seq) <= 2 * 300 + 4


def test_symbols_are_used_up_exactly():
    ids = np.repeat(np.arange(2, 9000, dtype=np.uint16), 2)
    seq, rules = repair.compress(np.tile(ids, 6), 65000, 1)
    assert len(rules) == (1 << 16) - 65000
    assert repair.Grammar(rules, 65000).expand(seq).tolist() == np.tile(ids, 6).tolist()


def test_a_tokenizer_that_cuts_otherwise():
    path = _WORDS.replace("word_bpe_49k", "byte_bpe_50k")
    texts = ["It's  1024 words", "", " \t", "naïve <|endoftext|> x"]
    whole = Tokenizer.from_file(path)
    ids, ends = repair.WordEncoder(path, 1).encode(texts)
    expected = [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == [i for one in expected for i in one]
    assert ends.tolist() == np.cumsum([len(one) for one in expected]).tolist()


def test_documents_of_a_shard():
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(2, 40, rng.integers(0, 400)), 1).astype(np.uint16) for _ in range(60)]
    docs += docs[:20]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    data = repair.pack([None, *range(1, len(docs))], ids, ends, 100, 1)
    shard = repair.Shard(data)
    assert shard.doc_ids[:3] == [None, 1, 2]
    assert np.array_equal(shard.decode(), ids)
    assert all(np.array_equal(shard.document(i), d) for i, d in enumerate(docs))
    assert len(shard.rules) and len(shard.symbols) < len(ids)
    with pytest.raises(ValueError, match="shard"):
        repair.Shard(b"none" + data[4:])


# --- inner products ---------------------------------------------------------------------

_VECTORS = "vec_id long, embedding array<float>, label int, rank int, score string, block int, v string"


def _vectors(rows):
    return [(i, e, 0, 1, "s", 2, "v") for i, e in rows]


def _best(rows, k):
    good = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in e]) for i, e in rows
            if i is not None and e is not None and all(x is not None and np.isfinite(np.float32(x)) for x in e)]
    asks = {}
    for i, v in good:
        if i % 100 == 0:
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, v in asks.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [8, 16_384])
def test_inner_products(spark, block):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=12) * rng.exponential()).tolist()) for i in range(420)]
    same = rng.normal(size=12).tolist()
    rows += [(i, same) for i in range(500, 800)]  # one very common vector
    rows += [(900, None), (901, []), (902, [float("nan")] * 12), (903, [None] * 12), (904, [float("inf")] * 12), (None, same)]
    rows += [(905, [1.0, 2.0]), (906, [0.0] * 12), (907, same), (907, same), (1000, [0.0] * 12), (1100, [2.0e4] * 12)]
    df = spark.createDataFrame(_vectors(rows), _VECTORS)
    got = inner_product.top_products(df, F.col("vec_id") % 100 == 0, block=block, sample=64)
    assert sorted(map(tuple, got.collect())) == _best(rows, 10)


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.25, -1.0]), (2, [0.5, 0.5])]
    asks = F.col("vec_id") % 100 == 0
    got = inner_product.top_products(spark.createDataFrame(_vectors(rows), _VECTORS), asks)
    assert sorted(map(tuple, got.collect())) == _best(rows, 10)
    assert inner_product.top_products(spark.createDataFrame([], _VECTORS), asks).count() == 0


# --- quality ----------------------------------------------------------------------------


def _good_and_bad(n):
    rng = random.Random(11)
    out = []
    for i, text in enumerate(cases.texts(n, 9)):
        if i % 3 == 0:
            words = text.split()
            junk = " ".join(f"{w.upper()}!!" for w in words)
            text = text + "\n" + junk if rng.random() < 0.5 else junk
        out.append((i, text, int(i % 3 != 0)))
    return out


def test_held_out_documents_are_told_apart(spark):
    known = _good_and_bad(600)
    docs = cases.frame(spark, [cases.row(i, t) for i, t, _ in known] + cases.awkward()[30:])
    labels = spark.createDataFrame([(i, q, 0, "x") for i, _, q in known] + [(None, 1, 0, "x"), (5, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    got = quality_mil.report(docs, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = {i: q for i, _, q in known}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    kept = quality_mil.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_scores_without_labels(spark):
    docs = cases.frame(spark, cases.awkward())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_mil.report(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    assert {r.score for r in quality_mil.report(docs, one).collect()} == {1.0}
    assert quality_mil.report(cases.frame(spark, []), one).count() == 0


def test_attention_weighs_all_passages():
    long = "plain words of a text " * 2000
    assert len(quality_mil.passages(long)) == 200
    assert not np.array_equal(quality_mil.passages(long + "!!!! " * 50)[-1], quality_mil.passages(long)[-1])
    assert quality_mil.passages(None).shape == quality_mil.passages("").shape == (1, quality_mil.FEATURES)


# --- multiset hash ----------------------------------------------------------------------


def test_edited_and_next(spark):
    rows = [cases.row(i, t) for i, t in enumerate(cases.texts(60))]
    rows += [cases.row(70, None), cases.row(71, ""), cases.row(72, "🙂" * 9), cases.row(73, rows[0][1]), cases.row(None, "last one.")]
    random.Random(1).shuffle(rows)
    docs = cases.frame(spark, rows)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    expected = []
    for at, r in enumerate(order):
        text, following = r[1] or "", order[(at + 1) % len(order)][1] or ""
        n = len(text)
        new = text[: n - n // 4] + following[: n // 4]
        a, b, c = (multiset_hash.fingerprint(t) for t in (text, new, following))
        expected.append(
            (r[0], n, hashlib.sha256(new.encode()).hexdigest(), multiset_hash.written(a), multiset_hash.written(b),
             multiset_hash.likeness(a, b), multiset_hash.likeness(a, c))
        )
    got = multiset_hash.report(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert multiset_hash.report(cases.frame(spark, [])).count() == 0
    assert [r.doc_id for r in multiset_hash.report(cases.frame(spark, [cases.row(4, "alone here.")])).collect()] == [4]


def _plain_fingerprint(text):
    """Sums in whole numbers, reduced at the end."""
    sums = [0] * (multiset_hash.WIDE + multiset_hash.SKETCH)
    for line in text.split("\n"):
        if not line.strip():
            continue
        wide = hashlib.shake_128(line.encode()).digest(4 * multiset_hash.WIDE)
        for i in range(multiset_hash.WIDE):
            sums[i] += int.from_bytes(wide[4 * i : 4 * i + 4], "little")
        for sentence in re.split(r"(?<=[.!?])\s+", line.strip()):
            bits = hashlib.blake2b(sentence.encode(), digest_size=multiset_hash.SKETCH // 8).digest()
            for i in range(multiset_hash.SKETCH):
                sums[multiset_hash.WIDE + i] += 1 if bits[i // 8] >> (7 - i % 8) & 1 else -1
    return sums


def test_fingerprints_are_plain_sums():
    texts = [*cases.texts(20), "", "one. two! three? four", " \n\t\nx"]
    for a, b in zip(texts, texts[1:], strict=False):
        x, y = _plain_fingerprint(a), _plain_fingerprint(b)
        assert [int(v) for v in multiset_hash.fingerprint(a)] == [v % 2**32 for v in x]
        dx, dy = x[multiset_hash.WIDE :], y[multiset_hash.WIDE :]
        size = sum(v * v for v in dx) + sum(v * v for v in dy)
        apart = sum((v - w) ** 2 for v, w in zip(dx, dy, strict=True))
        near = 1.0 if x == y else min(1, max(0, 1 - apart / size)) if size else 0.0
        assert multiset_hash.likeness(multiset_hash.fingerprint(a), multiset_hash.fingerprint(b)) == pytest.approx(near)


def test_likeness_of_very_long_texts():
    """Forty thousand sentences of one kind: sums do not wrap."""
    one, two = ("a sentence. " * 40_000).strip(), ("another one. " * 40_000).strip()
    x, y, both = (multiset_hash.fingerprint(t) for t in (one, two, f"{one} {two}"))
    assert multiset_hash.likeness(x, y) < 0.3
    assert 0.55 < multiset_hash.likeness(x, both) < 0.8


def test_ranges_agree_with_one_range(spark):
    rows = [cases.row(i // 2, t) for i, t in enumerate(cases.texts(90))]
    docs = cases.frame(spark, rows + rows[:3])
    found = []
    for size in (3, 1000):
        dealt = multiset_hash.with_following(docs, "doc_id", "text", rows_per_bucket=size).collect()
        buckets = {}
        for r in dealt:
            buckets.setdefault(r.bucket, []).append(r)
        following = []
        for part in buckets.values():
            own = sorted((r for r in part if not r.guest), key=lambda r: (r.key, r.body, r.text))
            guest = min((r for r in part if r.guest), key=lambda r: (r.key, r.body, r.text))
            following += [(a.text, b.text) for a, b in zip(own, [*own[1:], guest], strict=True)]
        found.append(sorted(following))
    assert len(buckets) == 1
    assert found[0] == found[1]


def test_sums_add_up():
    lines = cases.texts(20)
    whole = multiset_hash.total(lines)
    assert np.array_equal(whole, multiset_hash.total(lines[::-1]))
    assert np.array_equal(multiset_hash.changed(whole, lines[3:5], ["new"]), multiset_hash.total([*lines[:3], *lines[5:], "new"]))
    assert np.array_equal(multiset_hash.read(multiset_hash.written(whole)), whole)
    assert not np.array_equal(whole, multiset_hash.total([*lines, lines[0]]))
    near = multiset_hash.likeness(whole, multiset_hash.total(lines[:-2]))
    assert 0.7 < near < 1 > multiset_hash.likeness(whole, multiset_hash.total(cases.texts(20, 77))) + 0.6


# --- SimHash ----------------------------------------------------------------------------


def _simhash(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(fps, radius=3):
    """The index of each fingerprint's component, by comparing all pairs."""
    own = list(range(len(fps)))

    def find(a):
        while own[a] != a:
            own[a] = own[own[a]]
            a = own[a]
        return a

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                own[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def _similar():
    rows = cases.awkward()
    base = cases.texts(12, 21)
    rng = random.Random(2)
    for i, text in enumerate(base):
        long = " ".join(cases.texts(6, 50 + i)) + " " + text
        words = long.split(" ")
        for k in range(6):
            changed = list(words)
            changed[rng.randrange(len(words))] = f"new{k}"
            rows.append(cases.row(400 + 10 * i + k, " ".join(changed)))
    return rows


def test_near_duplicates(spark):
    rows = _similar()
    fps = [_simhash(r[1]) for r in rows]
    groups = _groups(fps)
    smallest = {}
    for r, g in zip(rows, groups, strict=True):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    docs = cases.frame(spark, rows)
    got = simhash.near_duplicates(docs)
    expected = [(r[0], f"{f:016x}", smallest.get(g)) for r, f, g in zip(rows, fps, groups, strict=True)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((smallest.get(g) for g in set(groups)), key=repr)
    assert simhash.near_duplicates(cases.frame(spark, [])).count() == 0
    assert simhash.representatives(cases.frame(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [2, 4])
def test_links_of_a_crowd_are_all_found(spark, parts):
    """Correlated bits, a dense ball and a crowded half of the bits."""
    rng = np.random.default_rng(8)
    centre = int(rng.integers(0, 2**63))
    fps = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(300)}
    fps |= {(0xABCDEF01 << 32) | int(x) for x in rng.integers(0, 2**32, 200)}
    fps |= {int(x) << 33 | int(x) for x in rng.integers(0, 2**31, 200)}
    signed = [f - 2**64 if f >= 2**63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(r.a, r.b) for r in simhash.links(df, 3, parts).collect()}
    mask = 2**64 - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_thresholds_add_up():
    rng = np.random.default_rng(3)
    near = rng.integers(0, 50, (4, 1 << 16, 4)).astype(np.float32)
    values = rng.integers(0, 1 << 16, (100, 4))
    for parts in (2, 4):
        found = simhash.thresholds(values, near, 1000, 3, parts)
        assert (found.sum(1) == 3 - parts + 1).all() and found.min() >= -1


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 580)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links = chain + star + loose + [(7, 7), (None, 3), (8, 9), (9, 8), (9, 8)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    own = {}
    for a, b in links:
        if a is not None and a != b:
            own.setdefault(a, a)
            own.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in own and b in own and own[a] != own[b]:
                own[a] = own[b] = min(own[a], own[b])
                changed = True
    assert got == own
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_words_keep_their_ids_when_a_worker_forgets_or_fails(monkeypatch):
    texts = ["Alpha beta, gamma.", "", "beta naïve. Straße 12 gamma!", "alpha, <|x|> betaİ delta"]
    expected = [repair.load(_WORDS, 1).encode([text])[0].tolist() for text in texts]
    encoder = repair.WordEncoder(_WORDS, 1)
    monkeypatch.setattr(repair, "REMEMBERED", 3)
    for text, ids in [*zip(texts, expected, strict=True)] * 2:
        assert encoder.encode_utf8([text.encode()])[0].tolist() == ids
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        encoder.encode(["words not met before"])
    monkeypatch.setattr(encoder, "_learn", learn)
    for text, ids in zip(texts, expected, strict=True):
        assert encoder.encode([text])[0].tolist() == ids
