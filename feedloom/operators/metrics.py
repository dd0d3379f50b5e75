"""Counts, distributions, pivots and top lists, for all games in one job."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Bound = str | date | datetime


def in_range(items: DataFrame, start: Bound, end: Bound, game_name: str | None = None) -> DataFrame:
    """Items in the closed range; a day without a time means its midnight, so
    the last day itself is cut."""
    since, until = (F.lit(bound).cast("timestamp") for bound in (start, end))
    chosen = items.where((F.col("timestamp") >= since) & (F.col("timestamp") <= until))
    return chosen if game_name is None else chosen.where(F.col("game_name") == game_name)


def topics_of_items(topics: DataFrame, items: DataFrame) -> DataFrame:
    """Topic rows of the given items, with the item's time.

    The game is part of the key so that a game filter reaches both scans.
    """
    keys = ["game_name", "content_id"]
    return topics.join(items.select(*keys, "timestamp"), keys)


def total_items(items: DataFrame) -> DataFrame:
    return items.groupBy("game_name").agg(F.count("*").alias("total_items"))


def overall_sentiment(items: DataFrame) -> DataFrame:
    return items.groupBy("game_name", "overall_sentiment").agg(
        F.count("*").alias("number_of_items")
    )


def category_sentiment(rated: DataFrame, normalise: bool = False) -> DataFrame:
    """Positive, negative and neutral topics per game and category."""
    word = F.lower(F.trim("sentiment")) if normalise else F.col("sentiment")
    return rated.groupBy("game_name", "category").agg(
        *[
            F.count_if(word == value).alias(f"number_of_{value}_items")
            for value in ("positive", "negative", "neutral")
        ]
    )


def subcategory_counts(rated: DataFrame) -> DataFrame:
    return rated.groupBy("game_name", "category", "sub_category", "sentiment").agg(
        F.count("*").alias("count")
    )


def top_subcategories(counts: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-neutral sub-categories per game and category.

    Neutral rows sort last instead of being filtered first. The ranks are the
    same, and the counts are those any other user of ``counts`` needs, so that
    Spark shuffles them once for both.
    """
    neutral = F.coalesce(F.col("sentiment"), F.lit("neutral")) == "neutral"
    order = [neutral, F.desc("count"), F.col("sub_category"), F.col("sentiment")]
    window = Window.partitionBy("game_name", "category").orderBy(*order)
    ranked = counts.withColumn("rank", F.row_number().over(window))
    return ranked.where((F.col("rank") <= k) & (F.col("sentiment") != "neutral"))


def distinct_games(items: DataFrame) -> DataFrame:
    return items.select("game_name").distinct()


def distinct_game_sources(items: DataFrame) -> DataFrame:
    return items.select("game_name", "content_type").distinct()
