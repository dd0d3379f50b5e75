"""Ranges, ties, empty reports, words nobody checked."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators import metrics
from feedloom.plans import reports


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        ("1", "g", "2025-01-01 00:00:00", "positive"),
        ("2", "g", "2025-01-31 00:00:00", "Positive"),
        ("3", "g", "2025-01-31 12:00:00", "negative"),
        ("4", "O'Neil", "2025-01-15 08:00:00", None),
        ("5", "late", "2026-01-01 00:00:00", "neutral"),
    ]
    made = spark.createDataFrame(rows, "content_id string, game_name string, t string, overall_sentiment string")
    return made.select(
        "content_id",
        "game_name",
        F.col("t").cast("timestamp").alias("timestamp"),
        "overall_sentiment",
        F.lit("Steam Review").alias("content_type"),
        F.concat(F.lit("a|b\nc "), "content_id").alias("translated_content_text"),
    )


@pytest.fixture(scope="module")
def topics(spark):
    rows = [("1", "g", "character", "positive", f"s{n}") for n in range(7)]
    rows += [("1", "g", "character", "neutral", "s0")] * 9
    rows += [("1", "g", "toxicity", "negative", None), ("2", "g", "toxicity", "Positive", "x")]
    rows += [("4", "O'Neil", "other", "negative", "price")]
    return spark.createDataFrame(
        rows, "content_id string, game_name string, category string, sentiment string, sub_category string"
    )


def test_last_day_is_cut_at_midnight(items):
    found = metrics.in_range(items, "2025-01-01", "2025-01-31", "g")
    assert sorted(r.content_id for r in found.collect()) == ["1", "2"]


def test_game_filter_reaches_both_scans(spark, items, topics, tmp_path):
    for name, df in (("items", items), ("topics", topics)):
        df.write.parquet(f"{tmp_path}/{name}")
    stored = spark.read.parquet(f"{tmp_path}/items"), spark.read.parquet(f"{tmp_path}/topics")
    rated = metrics.topics_of_items(stored[1], metrics.in_range(stored[0], "2025-01-01", "2025-01-31", "g"))
    plan = metrics.subcategory_counts(rated)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter (" in line]
    assert len(filters) == 2 and all("= g)" in line for line in filters)


def test_top_five_with_ties_and_without_neutral(items, topics):
    rated = metrics.topics_of_items(topics, metrics.in_range(items, "2025-01-01", "2025-01-31"))
    top = metrics.top_subcategories(metrics.subcategory_counts(rated))
    found = [tuple(r) for r in top.orderBy("game_name", "category", "rank").collect()]
    assert found == [
        ("O'Neil", "other", "price", "negative", 1, 1),
        *[("g", "character", f"s{n}", "positive", 1, n + 1) for n in range(5)],
        ("g", "toxicity", None, "negative", 1, 1),
        ("g", "toxicity", "x", "Positive", 1, 2),
    ]


def test_unchecked_words_fall_in_no_bucket_unless_normalised(items, topics):
    rated = metrics.topics_of_items(topics, items)
    toxic = F.col("category") == "toxicity"
    assert tuple(metrics.category_sentiment(rated).where(toxic).first())[2:] == (0, 1, 0)
    assert tuple(metrics.category_sentiment(rated, True).where(toxic).first())[2:] == (1, 1, 0)


def test_reports(items, topics):
    request = reports.Request("2025-01-01", "2025-01-31", datetime(2025, 2, 1), n_items=1)
    built = reports.build_reports(items, topics, request)
    found = {(r.game_name, r.persona): r.report_contents for r in built.collect()}
    assert len(found) == 9
    text = found["g", "marketer"]
    assert text.startswith("### Player feedback report for the Marketer\n\n2025-01-01 to 2025-01-31\n")
    assert "| total_items |\n| --- |\n| 2 |" in text
    assert "| Steam Review | a\\|b c 2 |" in text and "a\\|b c 1" not in text
    assert "| character | 7 | 0 | 9 |\n| toxicity | 0 | 1 | 0 |" in text
    assert "| toxicity |  | negative | 1 |" in text
    empty = found["late", "game_designer"]
    assert "| total_items |\n| --- |\n| 0 |" in empty and "| --- | --- |\n\n" in empty


def test_one_game(items, topics):
    request = reports.Request(
        "2025-01-01", "2025-01-31", datetime(2025, 2, 1), update_type="NEW_GAME", game_name="O'Neil"
    )
    built = reports.build_reports(items, topics, request)
    assert {r.game_name for r in built.collect()} == {"O'Neil"} and built.count() == 3


def test_counts_are_shuffled_once_for_both_tables(spark, items, topics, tmp_path):
    items.write.parquet(f"{tmp_path}/items")
    topics.write.parquet(f"{tmp_path}/topics")
    stored = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("items", "topics")]
    tables = reports.markdown_tables(stored[0], metrics.topics_of_items(stored[1], stored[0]))
    tables.collect()
    plan = tables._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2


def test_model_answers(items, topics):
    request = reports.Request(
        "2025-01-01", "2025-01-31", datetime(2025, 2, 1), load_model=lambda: lambda prompts: [p[:3] for p in prompts]
    )
    found = reports.build_reports(items, topics, request).collect()
    assert len(found) == 9 and all(r.report_contents.endswith("\n\nYou") for r in found)
