"""Broken and odd model answers; the two ways to build the topic table."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import extraction, quality

SOME = {"sentiment": "positive", "sub_topic": "aim"}
EMPTY = (None, None, None, None)

# JSON text → overall, sentiment and sub-topic of "character", number of other topics.
CASES = {
    "valid": (
        json.dumps(
            {
                "overall": "positive",
                "summary": "s",
                "character": SOME,
                "other": [{"topic": "t", "sentiment": "neutral"}],
            }
        ),
        ("positive", "positive", "aim", 1),
    ),
    "not json": ("sorry, no", EMPTY),
    "fenced": ('```json\n{"overall": "positive"}\n```', EMPTY),
    "null": (None, EMPTY),
    "empty text": ("", EMPTY),
    "no keys": ("{}", EMPTY),
    "category as text": (
        '{"overall": "negative", "character": "positive"}',
        ("negative", None, None, None),
    ),
    "cut short": ('{"overall": "positive", "summ', EMPTY),
    "unknown key": ('{"overall": "neutral", "weather": 1}', ("neutral", None, None, None)),
    "other case": ('{"Overall": "neutral"}', EMPTY),
    "null category, empty other": (
        '{"overall": "neutral", "character": null, "other": []}',
        ("neutral", None, None, 0),
    ),
    "number as overall": ('{"overall": 5}', ("5", None, None, None)),
    "list on top": ('[{"overall": "positive"}]', EMPTY),
    "other as object": (
        '{"overall": "positive", "other": {"topic": "t"}}',
        ("positive", None, None, None),
    ),
    "unchecked word": ('{"overall": "Positive"}', ("Positive", None, None, None)),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [
        (name, "Steam Review", "O'Neil's / game", "text", "author", "{}", "text", answer)
        for name, (answer, _) in CASES.items()
    ]
    columns = (
        "content_id string, content_type string, game_name string, content_text string, "
        "author_id string, content_metadata string, translated_content_text string, "
        "content_topic string"
    )
    made = spark.createDataFrame(rows, columns)
    return made.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def test_odd_answers(extracted):
    wide = extraction.parsed_wide(extracted)
    size = F.when(F.col("other").isNotNull(), F.size("other"))
    found = {
        row[0]: tuple(row)[1:]
        for row in wide.select(
            "content_id", "overall", "character", "character_sub_topic", size
        ).collect()
    }
    assert found == {name: expected for name, (_, expected) in CASES.items()}


def test_wide_columns(extracted):
    wide = extraction.parsed_wide(extracted)
    assert wide.schema.simpleString() == (
        extracted.sparkSession.createDataFrame([], schemas.parsed_ddl()).schema.simpleString()
    )
    assert len(wide.columns) == 39


def test_quality_rule_drops_and_counts(extracted):
    kept_ids = {name for name, (_, expected) in CASES.items() if expected[0] is not None}
    seen = Observation()
    kept = extraction.parsed(extracted, observation=seen)
    assert {row.content_id for row in kept.select("content_id").collect()} == kept_ids
    counts = {"rows": len(CASES), "valid_overall_sentiment": len(CASES) - len(kept_ids)}
    assert seen.get == counts
    metrics = quality.expect_metrics(extraction.parsed_wide(extracted)).first()
    assert (metrics.passed, metrics.dropped) == (len(kept_ids), len(CASES) - len(kept_ids))


def test_one_pass_topics_equal_two_branches(extracted):
    parsed = extraction.parsed(extracted)
    one = extraction.gold_topics(parsed)
    two = extraction.union_topics(
        extraction.category_topics(parsed), extraction.other_topics(parsed)
    )
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.columns == ["content_id", "game_name", "category", "sentiment", "sub_category"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1


def test_categories_are_a_parameter(extracted):
    wide = extraction.parsed_wide(extracted, ["character", "weather"])
    assert wide.columns[9:13] == ["character", "character_sub_topic", "weather", "weather_sub_topic"]
    with pytest.raises(ValueError):
        schemas.extraction_ddl(["a", "a"])
