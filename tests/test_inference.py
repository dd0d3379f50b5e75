"""The contract of models: one call per text, failures as data, hot texts."""

from __future__ import annotations

import glob
from functools import partial
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from feedloom.functions.offline import Lexicon, glossary_translate, lexicon_extract
from feedloom.functions.prompts import extraction_prompt
from feedloom.operators import inference, tables
from feedloom.plans.staging import fresh_path
from feedloom.streaming import chain as streams
from feedloom.streaming.upsert import upsert


def rows(spark):
    texts = ["good game"] * 700 + ["bad"] * 5 + [None] * 300 + [f"text {i}" for i in range(50)]
    made = [(str(i), text) for i, text in enumerate(texts)]
    return spark.createDataFrame(made, "content_id string, content_text string").repartition(5)


def test_every_text_is_asked_once_and_rows_are_whole(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        from uuid import uuid4

        def model(texts):
            for text in texts:
                with open(f"{folder}/{uuid4().hex}", "w") as log:
                    log.write(text)
            return [text.upper() for text in texts]

        return model

    df = rows(spark)
    out = inference.infer(df, F.col("content_text"), "answer", load)
    for _ in range(2):
        found = {r.content_id: (r.content_text, r.answer, r.answer_error) for r in out.collect()}
    assert len(found) == df.count()
    assert all(a == (t.upper() if t else None) and e is None for t, a, e in found.values())
    asked = sorted(open(path).read() for path in glob.glob(f"{folder}/*"))
    assert asked == sorted({r.content_text for r in df.collect() if r.content_text})


def test_a_failing_text_spoils_no_other(spark):
    def load():
        def model(texts):
            if "bad" in texts:
                raise RuntimeError("no answer")
            return [t + "!" for t in texts]

        return model

    out = inference.translate(rows(spark), load, tasks=2)
    failed = out.where("translated_content_text_error IS NOT NULL").collect()
    assert [r.content_text for r in failed] == ["bad"] * 5
    assert {r.translated_content_text_error for r in failed} == {"RuntimeError: no answer"}
    assert out.where("translated_content_text IS NOT NULL").count() == 750


def test_batches_are_small(spark):
    def load():
        return lambda texts: [str(len(texts))] * len(texts)

    df = spark.range(100).select(
        F.col("id").cast("string").alias("content_id"), F.col("id").cast("string").alias("content_text")
    )
    out = inference.translate(df, load, tasks=1, batch_size=30)
    sizes = out.groupBy("translated_content_text").count().collect()
    assert {tuple(row) for row in sizes} == {("30", 90), ("10", 10)}


def test_wrong_number_of_answers_is_a_failure(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "content_id string, content_text string")
    out = inference.translate(df.coalesce(1), lambda: lambda texts: ["one"], tasks=1)
    assert {r.translated_content_text for r in out.collect()} == {"one"}


def test_extraction_sends_the_prompt(spark):
    out = inference.extract(rows(spark), lambda: lambda prompts: [p[-9:] for p in prompts])
    assert out.where("content_text = 'good game' AND content_topic = 'good game'").count() == 700
    assert out.where("content_text IS NULL AND content_topic IS NULL").count() == 300
    assert '"onboarding"' in extraction_prompt()


@pytest.mark.parametrize(
    ("language", "text", "translated"),
    [
        ("fr", "Le jeu,\nest bon!", "the game,\nis good!"),
        ("de", "Das Spiel ist gut", "the game is good"),
        ("en", "Das Spiel", "Das Spiel"),
        (None, "Das Spiel", "Das Spiel"),
        ("es", None, None),
        ("es", "", ""),
    ],
)
def test_glossary(spark, language, text, translated):
    df = spark.createDataFrame([(text, language)], "content_text string, lang string")
    out = glossary_translate(df, language=F.col("lang"))
    assert out.first().translated_content_text == translated
    assert out.columns == ["content_text", "lang", "translated_content_text"]


@pytest.mark.parametrize(
    ("text", "answer"),
    [
        (
            "Great combat, but the LAG!",
            '{"overall":"positive","summary":"positive: combat, lag",'
            '"fight":{"sentiment":"positive","sub_topic":"combat"},'
            '"speed":{"sentiment":"positive","sub_topic":"lag"},"other":[]}',
        ),
        (
            "bad bad story. great",
            '{"overall":"neutral","summary":"neutral","other":[{"topic":"story","sentiment":"neutral"}]}',
        ),
        ("   ", '{"other":[]}'),
        (None, None),
    ],
)
def test_lexicon(spark, text, answer):
    lexicon = Lexicon(["great"], ["bad"], {"fight": ["combat"], "speed": ["fps", "lag"]}, ["story"])
    df = spark.createDataFrame([(text,)], "content_text string")
    out = lexicon_extract(df, lexicon=lexicon, categories=["fight", "speed"])
    assert out.first().content_topic == answer


def test_models_in_the_chain(spark):
    """A model that fails on one item: the item is dropped by the rule, and counted."""
    database = f"models_{uuid4().hex}"
    tables.use_database(spark, database, fresh_path(spark, database))

    def load():
        def model(prompts):
            if any("secret" in p for p in prompts):
                raise RuntimeError("refused")
            return ['{"overall":"positive","toxicity":{"sentiment":"negative"}}'] * len(prompts)

        return model

    quality = []
    chain = streams.Chain(
        database,
        checkpoints=fresh_path(spark, "checkpoints"),
        translate=partial(inference.translate, load_model=lambda: lambda texts: [t.upper() for t in texts]),
        extract=partial(inference.extract, load_model=load),
        on_quality=quality.append,
    )
    rows = spark.range(20).select(
        F.col("id").cast("string").alias("content_id"),
        F.lit("Steam Review").alias("content_type"),
        F.lit("g").alias("game_name"),
        F.when(F.col("id") == 7, "secret").when(F.col("id") != 8, "same").alias("content_text"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        F.lit("a").alias("author_id"),
        F.lit("{}").alias("content_metadata"),
    )
    upsert(rows, chain.table(streams.BRONZE))
    streams.refresh(spark, chain)
    # The same rows in new files: seen by every stream, added by none.
    first = spark.table(chain.table(streams.BRONZE)).first().batch_id
    tables.write_batch(rows, chain.table(streams.BRONZE), first)
    streams.refresh(spark, chain)

    assert [c["rows"] for c in quality][0] == 20
    assert sum(c["valid_overall_sentiment"] for c in quality) == 2
    items = spark.table(chain.table(streams.ITEMS))
    assert items.count() == 18 and items.where("translated_content_text = 'SAME'").count() == 18
    topics = spark.table(chain.table(streams.TOPICS))
    assert topics.groupBy("category", "sentiment").count().collect() == [("toxicity", "negative", 18)]


@pytest.mark.parametrize("n", [60, 5000])
def test_texts_are_dealt_by_number(spark, n):
    def load():
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        return lambda texts: [str(part) for _ in texts]

    df = spark.range(n).select(F.col("id").cast("string").alias("content_id"))
    answered = inference.infer(df, F.concat(F.lit("text "), "content_id"), "out", load)
    assert answered.select("out").distinct().count() > 1


def test_directions_are_not_part_of_the_grouped_text(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "content_id string, content_text string")
    answered = inference.infer(df, F.col("content_text"), "out", lambda: lambda texts: list(texts), directions="say: ")
    assert {(r.content_id, r.out) for r in answered.collect()} == {("1", "say: a"), ("2", "say: b"), ("3", None)}
