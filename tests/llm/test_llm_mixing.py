"""The mix: targets, places and cuts against a plain Python run of the same queue."""

from __future__ import annotations

import hashlib
import re

import pytest
from llm_path import cases
from pyspark.sql import functions as F

from feedloom.llm import mixing


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes, epochs=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_now, budget = {}, set(names), sum(sizes.values())
    while open_now:
        total = sum(weight[s] for s in open_now)
        left = budget - sum(target.values())
        over = [s for s in open_now if left * weight[s] > epochs * sizes[s] * total]
        if not over:
            target.update({s: left * weight[s] / total for s in open_now})
            break
        target.update({s: float(epochs * sizes[s]) for s in over})
        open_now -= set(over)
    return target


def _expected(rows, epochs=3):
    docs = [(d, s, _size(t), hashlib.md5((t or "").encode()).hexdigest()) for d, t, s in rows]
    sizes = {}
    for _, s, n, _ in docs:
        sizes[s] = sizes.get(s, 0) + n
    target = _targets(sizes, epochs)
    placed = []
    for d, s, n, body in docs:
        name = f"{'' if d is None else d}:{n}:{body}"
        placed.append((s, int(hashlib.md5(name.encode()).hexdigest()[:15], 16), d, n))
    copies = []
    none_first = lambda d: (d is not None, d or 0)
    for s in sizes:
        run = 0
        for _, place, d, n in sorted((p for p in placed if p[0] == s), key=lambda p: (p[1], none_first(p[2]), p[3])):
            run += n
            for e in range(epochs):
                copies.append(((e * sizes[s] + run) / target[s] if target[s] else 0.0, place, none_first(d), s is None, s or "", n, e, s))
    total, last = 0, {}
    for c in sorted(copies, key=lambda c: c[:7]):
        total += c[5]
        if total > sum(sizes.values()):
            break
        last[c[7]] = max(last.get(c[7], (0, -1)), (c[6], c[1]))
    out = []
    for s, place, d, n in placed:
        e, end = last.get(s, (0, -1))
        out.append((d, n, sizes[s], target[s], n * (e + (place <= end))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["awkward", "many", "one"])
def test_mix_is_the_queue(spark, which):
    rows = {
        "awkward": cases.awkward(),
        "many": [cases.row(i, t, source=f"s{min(i % 9, 5)}") for i, t in enumerate(cases.texts(200))],
        "one": [cases.row(7, "just one document")],
    }[which]
    got = mixing.mixed_sizes(cases.frame(spark, rows))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, got.collect()), key=repr) == _expected([(r[0], r[1], r[3]) for r in rows])


def test_documents_are_repeated_as_taken(spark):
    rows = [cases.row(i, t, source=f"s{min(i % 9, 5)}") for i, t in enumerate(cases.texts(120))]
    docs = cases.frame(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in mixing.mixed_sizes(docs).collect():
        assert r.taken == r.size * times.get(r.doc_id, 0)
    shares = mixing.mixed_sizes(docs)
    for r in shares.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken"), F.first("target")).collect():
        assert abs(r[1] - r[2]) <= 120


def test_hot_source_and_small_buckets(spark):
    rows = [cases.row(i, t, source="hot" if i % 3 else f"s{i % 5}") for i, t in enumerate(cases.texts(300))]
    docs = cases.frame(spark, rows)
    sizes = mixing.sized(docs).cache()
    shares = mixing.targets(sizes).cache()
    whole = {tuple(r) for r in mixing.cuts(sizes, shares).collect()}
    assert {tuple(r) for r in mixing.cuts(sizes, shares, rows_per_bucket=1).collect()} == whole


def test_rows_without_ids_reach_their_targets(spark):
    """Two thirds of the rows have no id and one size: they are spread by their texts."""
    rows = [cases.row(None if i % 3 else i, f"{i} " + "word " * 9, source=f"s{i % 2}") for i in range(6000)]
    sources = mixing.mixed_sizes(cases.frame(spark, rows)).groupBy("source_size", "target").agg(F.sum("taken")).collect()
    # Both sources have as many words, so they may come as one group of two.
    assert sum(r[2] for r in sources) == pytest.approx(sum(r["target"] for r in sources), rel=0.01)
    placed = mixing.sized(cases.frame(spark, rows)).agg(F.count_distinct("place")).first()[0]
    assert placed == 6000


def test_empty(spark):
    assert mixing.mixed_sizes(cases.frame(spark, [])).count() == 0
    assert mixing.mixed_documents(cases.frame(spark, [])).count() == 0
