"""Near-duplicates by HyperMinHash against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
from llm_path import cases

from feedloom.llm import hyperminhash
from feedloom.llm.hyperminhash import near_duplicates


def _set(text, width=2):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def _expected(docs, width=2):
    sets = [_set(t, width) for _, t in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        component = least.get(find(i))
        out.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return sorted(map(repr, out))


def _found(spark, docs, **options):
    rows = near_duplicates(cases.frame(spark, [cases.row(i, t) for i, t in docs]), **options).collect()
    return sorted(map(repr, (tuple(r) for r in rows)))


def _edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_awkward_rows_and_an_empty_table(spark):
    docs = [(r[0], r[1]) for r in cases.awkward()]
    assert _found(spark, docs) == _expected(docs)
    assert _found(spark, docs, width=5) == _expected(docs, 5)
    assert near_duplicates(cases.frame(spark, [])).count() == 0


def test_a_crowd_of_near_copies_with_outsiders(spark):
    """Copies with few to many edits: some reach the group only through others, some not at all."""
    rng = random.Random(4)
    base = [f"v{rng.randrange(40)}" for _ in range(80)]
    docs = [(i, _edited(base, rng.choice([0, 1, 2, 3, 4, 5, 6, 8]), rng)) for i in range(150)]
    docs += [(200 + i, t) for i, t in enumerate(cases.texts(40))]
    docs += [(300 + i, _edited(cases.texts(1, i)[0].split() or ["x"], 1, rng)) for i in range(20)]
    assert _found(spark, docs) == _expected(docs)


def test_small_sets(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choices("abc", k=rng.randint(1, 7)))) for i in range(120)]
    assert _found(spark, docs) == _expected(docs)


def test_chains_and_pairs_at_exactly_the_threshold(spark):
    words = [f"c{i}" for i in range(60)]
    docs = [(i, " ".join(words[i : i + 10])) for i in range(50)]  # nine shingles, eight in common: 80 %
    assert _found(spark, docs) == _expected(docs)
    assert {eval(r)[2] for r in _found(spark, docs)} == {0}


def test_registers_keep_the_least_hash_of_a_bucket():
    hashes = np.random.default_rng(1).integers(0, 2**64, 3000, np.uint64)
    found = hyperminhash.registers(hashes)
    bucket = [(int(h) >> 32) * hyperminhash.REGISTERS >> 32 for h in hashes]
    values = hyperminhash._mixed(hashes + hyperminhash._ODD[0])
    for b in range(hyperminhash.REGISTERS):
        own = [int(v) for v, k in zip(values, bucket, strict=True) if k == b]
        if not own:
            assert found[b] == 0
            continue
        zeros = 64 - min(own).bit_length()
        mantissa = (min(own) >> (63 - zeros - 10)) & 1023
        assert found[b] == 1 + (zeros << 10) + 1023 - mantissa


def test_estimates_and_bands_follow_the_similarity():
    rng = np.random.default_rng(2)
    for size in (8, 200, 5000):
        for shared in (0.3, 0.8):
            agree, near = [], []
            for _ in range(40):
                n = int(size * (1 + shared) / 2)
                both = rng.integers(0, 2**64, int(size * shared), np.uint64)
                a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**64, n - len(both), np.uint64)])) for _ in range(2))
                x, y = hyperminhash.registers(a), hyperminhash.registers(b)
                agree.append((hyperminhash.bands(x) == hyperminhash.bands(y)).any())
                near.append(hyperminhash.may_reach(x, y, len(a), len(b)))
            if len(both) / (2 * n - len(both)) >= 0.8:
                assert all(agree) and all(near)
            elif size == 5000:
                assert not any(near)
    assert 0 < hyperminhash._chance(1000, 1000) < 0.001
