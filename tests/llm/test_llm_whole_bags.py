"""The classifier learns from all passages of the documents it takes."""

from __future__ import annotations

import numpy as np
import pytest
from llm_path import cases

from feedloom.llm import quality_mil


@pytest.fixture
def learned(monkeypatch):
    seen = []
    monkeypatch.setattr(quality_mil, "learn", lambda bags, labels: seen.append(bags) or quality_mil.Model(0.5))
    return seen


def test_long_documents_are_seen_whole(spark, learned):
    rows = [cases.row(i, f"word{i} of a text " * 5000) for i in (1, 2, 4)]
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 4)], "doc_id long, quality int")
    docs = cases.frame(spark, rows)
    quality_mil.fit(docs, labels)
    whole = {r[0]: quality_mil.passages(r[1]) for r in rows}
    bags = learned.pop()
    assert bags and all(len(b) == 400 for b in bags)
    assert all(any(np.array_equal(b, w) for w in whole.values()) for b in bags)
    quality_mil.fit(docs, labels, passages_most=500)
    assert [len(b) for b in learned.pop()] == [400]


def test_reruns_take_the_same_texts_of_an_id(spark, learned):
    rows = [cases.row(1, f"text {'x' * i}, {i}") for i in range(80)] + [cases.row(2, "one.")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    for n in (1, 7):
        quality_mil.fit(cases.frame(spark, rows).repartition(n), labels, documents=5)
    first, again = learned
    assert len(first) == len(again) > 0
    assert all(np.array_equal(a, b) for a, b in zip(first, again, strict=True))
