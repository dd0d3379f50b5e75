"""Counts kept by batch and day, and answers kept across batches."""

from __future__ import annotations

from datetime import date, datetime
from functools import partial
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from test_tables import ODD, feedback

from feedloom.operators import inference, tables
from feedloom.operators.inference import AnswerStore, infer
from feedloom.plans import counts
from feedloom.plans.reports import Request, build_reports_from_parsed
from feedloom.plans.staging import fresh_path
from feedloom.streaming import chain as streams
from feedloom.streaming.upsert import upsert


@pytest.fixture
def chain(spark):
    name = f"test_{uuid4().hex}"
    tables.use_database(spark, name, fresh_path(spark, name))
    return streams.Chain(name, checkpoints=fresh_path(spark, "checkpoints"))


def reports_of(spark, chain, request):
    parsed = tables.items_of(spark, chain.table(streams.PARSED))
    kept = [spark.table(chain.table(name)) for name in (counts.COUNTS, counts.LATEST)]
    found = [build_reports_from_parsed(parsed, request), counts.build_reports_from_counts(*kept, request)]
    return [sorted(map(repr, df.collect())) for df in found]


def deliver(spark, chain, rows):
    upsert(feedback(spark, rows), chain.table(streams.BRONZE))
    streams.refresh(spark, chain)


def test_reports_out_of_counts(spark, chain):
    """Midnights, items without time or game, games without items in range, merged and deleted batches."""
    request = Request("2024-01-01", "2024-01-03", datetime(2024, 1, 4), n_items=3)
    one = Request(date(2024, 1, 1), date(2024, 1, 2), datetime(2024, 1, 4), "NEW_GAME", ODD, n_items=3)
    first = [(f"a{i}", ("g", ODD, None)[i % 3], f"good lag price {i}", f"2024-01-0{1 + i % 3}") for i in range(12)]
    first += [("m", "g", "bad story", "2024-01-03 00:00:01"), ("n", "late", "good", "2024-02-01"), ("o", "g", "fun", None)]
    deliver(spark, chain, first)
    assert len(counts.update_counts(spark, chain)) == 1 and counts.update_counts(spark, chain) == []
    deliver(spark, chain, [(f"b{i}", ("g", ODD)[i % 2], "worst bug ever", f"2024-01-02 0{i}:00:00") for i in range(8)])
    assert len(counts.update_counts(spark, chain)) == 1
    for chosen in (request, one):
        whole, kept = reports_of(spark, chain, chosen)
        assert whole == kept and whole
    assert len(tables.compact(spark, chain.table(streams.PARSED), 1)) == 2
    tables.delete_game(spark, [chain.table(streams.PARSED)], "g")  # from this table alone
    assert counts.update_counts(spark, chain) == []
    assert spark.table(chain.table(counts.COUNTS)).where("game_name = 'g'").isEmpty()
    assert tables.batches(spark, chain.table(counts.COUNTS)) == tables.batches(spark, chain.table(streams.PARSED))
    whole, kept = reports_of(spark, chain, request)
    assert whole == kept and len(whole) == 3 * 3
    counts.write_reports_from_counts(spark, chain, request)
    assert spark.table(chain.table(streams.REPORTS)).count() == 9


def test_a_merge_of_batches_that_were_not_counted_is_read(spark, chain):
    deliver(spark, chain, [("1", "g", "good", "2024-01-01")])
    counts.update_counts(spark, chain)
    deliver(spark, chain, [("2", "g", "bad", "2024-01-01")])
    tables.compact(spark, chain.table(streams.PARSED), 1)
    assert len(counts.update_counts(spark, chain)) == 1
    whole, kept = reports_of(spark, chain, Request("2024-01-01", "2024-01-02", datetime(2024, 1, 4)))
    assert whole == kept


def test_only_days_and_kept_items(spark, chain):
    deliver(spark, chain, [("1", "g", "good", "2024-01-01")])
    counts.update_counts(spark, chain)
    kept = [spark.table(chain.table(name)) for name in (counts.COUNTS, counts.LATEST)]
    with pytest.raises(ValueError, match="not a midnight"):
        counts.build_reports_from_counts(*kept, Request("2024-01-01 10:00:00", "2024-01-02", datetime(2024, 1, 4)))
    with pytest.raises(ValueError, match="cannot be listed"):
        counts.build_reports_from_counts(*kept, Request("2024-01-01", "2024-01-02", datetime(2024, 1, 4), n_items=99))


# --- answers ------------------------------------------------------------------------------


def answering(word, fails=()):
    def load():
        def ask(texts):
            if any(t in fails for t in texts):
                raise RuntimeError("no answer")
            return [None if t == "silent" else f"{word} {t}" for t in texts]

        return ask

    return load


def texts_of(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "content_id string, content_text string")


def answers(df):
    return [(r.content_text, r.answer) for r in df.orderBy("content_id").collect()]


def test_kept_answers_are_not_asked_again(spark):
    store = AnswerStore(fresh_path(spark, "store"), "v1")
    ask = partial(infer, text=F.col("content_text"), out_col="answer", store=store)
    first = answers(ask(texts_of(spark, "a", "b", "a", None, "silent", ""), load_model=answering("one", fails=("b",))))
    assert first == [("a", "one a"), ("b", None), ("a", "one a"), (None, None), ("silent", None), ("", "one ")]
    second = answers(ask(texts_of(spark, "a", "b", "c", "silent", None), load_model=answering("two")))
    # What failed is asked again; no answer is an answer.
    assert second == [("a", "one a"), ("b", "two b"), ("c", "two c"), ("silent", None), (None, None)]
    other = AnswerStore(store.folder, "v2")
    assert answers(infer(texts_of(spark, "a"), F.col("content_text"), "answer", answering("three"), store=other)) == [("a", "three a")]
    told = infer(texts_of(spark, "a"), F.col("content_text"), "answer", answering("four"), store=store, directions="be brief: ")
    assert answers(told) == [("a", "four be brief: a")]


def test_a_chain_keeps_answers_over_refreshes(spark, chain):
    """Another item with a known text costs no question, though the model has changed its mind."""
    store = AnswerStore(fresh_path(spark, "store"))
    seen = []
    for n, word in enumerate(("one", "two")):
        own = streams.Chain(
            chain.database,
            checkpoints=chain.checkpoints,
            translate=partial(inference.translate, load_model=answering(word), store=store),
        )
        deliver(spark, own, [(f"{n}{i}", "g", text, "2024-01-01") for i, text in enumerate(("good", f"new {n}"))])
        rows = spark.table(chain.table(streams.TRANSLATED)).orderBy("content_id").collect()
        seen = [r.translated_content_text for r in rows]
    assert seen == ["one good", "one new 0", "one good", "two new 1"]
