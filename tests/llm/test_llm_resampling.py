"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_path import cases

from feedloom.llm import resampling
from feedloom.llm.resampling import Interned, draw, resampled

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _grams(text, longest):
    words = _WORD.findall((text or "").encode().lower())
    return words, [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def _expected(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    def counts(texts):
        return Counter(zlib.crc32(g) % buckets for t in texts for g in _grams(t, longest)[1])

    own, wanted = counts(t for _, t in docs), counts(target)
    s_all, t_all = sum(own.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((own[b] + 1) * (t_all + buckets))))

    rows = []
    for doc_id, text in docs:
        words, grams = _grams(text, longest)
        weight = sum(gain(zlib.crc32(g) % buckets) for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(words), len(grams), weight, score))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(*r, i + 1) for i, r in enumerate(fit[: percent * len(fit) // 100])]
    return rows, drawn


def _frames(spark, docs, target):
    rows = [cases.row(i, t) for i, t in docs]
    return cases.frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string")


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_plain_python(spark, longest):
    docs = [(r[0], r[1]) for r in cases.awkward()] + [(100 + i, t) for i, t in enumerate(cases.texts(60, 9))]
    target = [*cases.texts(5, 9), None, "", "Straße 123 x_y"]
    found = resampled(*_frames(spark, docs, target), longest=longest, percent=30).collect()
    rows, drawn = _expected(docs, target, longest, percent=30)
    assert sorted(map(repr, (tuple(r)[:5] for r in found))) == sorted(map(repr, rows))
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["score"], r["doc_id"]) for r in ranked] == [(d[4], d[0]) for d in drawn]


def test_empty_tables(spark):
    docs, target = _frames(spark, [(1, "a b")], ["a"])
    assert resampled(docs.limit(0), target).count() == 0
    one = resampled(docs, target.limit(0)).collect()
    assert [(r["n_features"], r["rank"]) for r in one] == [(2, None)]


def test_ties_are_ranked_over_many_ranges(spark):
    """Most rows are alike in score and id: they are spread, and every rank is given once."""
    rows = [(7, 30, 30, 5, 100)] * 900 + [(i, 30, 30, 5, 100 + i % 2) for i in range(100)]
    path = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    found = draw(resampling.stage(path, "tested"), percent=50).where("rank IS NOT NULL").orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 501))
    expected = sorted(rows, key=lambda r: (-r[4], r[0]))[:500]
    assert [(r["score"], r["doc_id"]) for r in found] == [(r[4], r[0]) for r in expected]


def test_the_table_tells_words_apart_whatever_their_keys(monkeypatch):
    """With equal keys for all, probing and the comparison of bytes still count every word right."""
    monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda data: 5)
    texts = ["b a b", None, "a ab abc", "", "b " * 50]
    table = Interned(texts, 2, 10_000)
    grams = [g for t in texts for g in _grams(t, 2)[1]]
    counts = Counter(zlib.crc32(g) % 10_000 for g in grams)
    assert {b: int(n) for b, n in zip(table.bucket, table.count, strict=True) if n} == counts
    assert table.words.tolist() == [3, 0, 3, 0, 50]
    by_doc = [Counter(table.bucket[table.slot[table.doc == d]].tolist()) for d in range(5)]
    assert by_doc == [Counter(zlib.crc32(g) % 10_000 for g in _grams(t, 2)[1]) for t in texts]


def test_pieces_of_text_give_the_same_counts(monkeypatch):
    import pyarrow as pa

    texts = cases.texts(30)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    monkeypatch.setattr(resampling, "CHUNK", 200)
    pieces = [p for _, p in resampling._chunks([batch], 0)]
    assert len(pieces) > 5 and sum(pieces, []) == texts
    whole = Interned(texts, 1, 500)
    parts = sum(np.bincount(t.bucket, t.count, 500) for t in (Interned(p, 1, 500) for p in pieces))
    assert np.array_equal(np.bincount(whole.bucket, whole.count, 500), parts)
