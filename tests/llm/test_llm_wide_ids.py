"""Next documents of tables with wide ids and many NULL ids."""

from __future__ import annotations

import random
from collections import Counter

from llm_path import cases
from pyspark.sql import functions as F

from feedloom.llm import multiset_hash


def _following(docs, size):
    """Each row's text with the next one's, out of the dealt ranges."""
    buckets, found = {}, []
    for r in multiset_hash.with_following(docs, "doc_id", "text", rows_per_bucket=size).collect():
        buckets.setdefault(r.bucket, []).append(r)
    for part in buckets.values():
        own = [r for r in part if not r.guest]
        guest = next(r for r in part if r.guest)
        found += [(a.doc_id, a.text, b.doc_id, b.text) for a, b in zip(own, [*own[1:], guest], strict=True)]
    return found, Counter({b: sum(not r.guest for r in part) for b, part in buckets.items()})


def test_ids_no_double_can_hold(spark):
    ids = [s * (2**e) + i for e in (43, 53, 60, 62) for s in (1, -1) for i in range(12)] + [2**63 - 1 - i for i in range(9)] + [-(2**63)]
    assert len(set(ids)) == len(ids)
    texts = cases.texts(len(ids) + 1)
    rows = [*zip(ids, texts), (None, texts[-1])]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    expected = [(*a, *b) for a, b in zip(order, [*order[1:], order[0]], strict=True)]
    random.Random(5).shuffle(rows)
    docs = cases.frame(spark, [cases.row(i, t) for i, t in rows])
    for size in (1, 4, 1000):
        assert sorted(_following(docs, size)[0], key=repr) == sorted(expected, key=repr)
    got = {r.doc_id: r.near_next for r in multiset_hash.report(docs).collect()}
    prints = [multiset_hash.fingerprint(t) for _, t in order]
    for at, (i, _) in enumerate(order):
        assert got[i] == multiset_hash.likeness(prints[at], prints[(at + 1) % len(order)])


def test_many_null_and_equal_ids_spread(spark):
    texts = [f"text {i}" for i in range(1200)]
    rows = [cases.row((None, 2**60, i)[i % 3], t) for i, t in enumerate(texts)]
    docs = cases.frame(spark, rows)
    hashes = {r.text: r.body for r in docs.select("text", F.xxhash64("text").alias("body")).collect()}
    order = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    found, sizes = _following(docs, 20)
    assert sorted(found, key=repr) == sorted(((*a, *b) for a, b in zip(order, [*order[1:], order[0]], strict=True)), key=repr)
    assert max(sizes.values()) <= 20
