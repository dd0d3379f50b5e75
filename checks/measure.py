"""Filters, joins, aggregates and top lists on the gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check, views
from checks.views import plain, sql
from feedloom.functions.prompts import PERSONAS
from feedloom.operators import merge, metrics
from feedloom.plans import reports

START, END = "2024-01-01", "2024-01-03"
_RANGE = f"timestamp >= TIMESTAMP '{START}' AND timestamp <= TIMESTAMP '{END}'"
_RATED = (
    "SELECT t.*, i.timestamp FROM topics t JOIN items i "
    f"ON i.game_name = t.game_name AND i.content_id = t.content_id WHERE i.{_RANGE.replace(' AND ', ' AND i.')}"
)


def chosen(spark, sf):
    return metrics.in_range(views.items(spark, sf), START, END)


def rated(spark, sf):
    return metrics.topics_of_items(views.topics(spark, sf), chosen(spark, sf))


@check("filter_game_range", sql(f"SELECT * FROM items WHERE game_name = 'src3' AND {_RANGE}"))
def filter_game_range(spark, sf):
    return plain(metrics.in_range(views.items(spark, sf), START, END, "src3"))


@check("join_topics_items", sql(_RATED))
def join_topics_items(spark, sf):
    return plain(rated(spark, sf))


@check(
    "games_x_personas",
    sql(
        "SELECT DISTINCT game_name, persona FROM items, "
        f"unnest([{', '.join(repr(p.name) for p in PERSONAS)}]) AS p(persona)"
    ),
)
def games_x_personas(spark, sf):
    games = metrics.distinct_games(views.items(spark, sf))
    return reports.for_personas(games).select("game_name", "persona")


@check(
    "total_items",
    sql(f"SELECT game_name, count(*) AS total_items FROM items WHERE {_RANGE} GROUP BY game_name"),
)
def total_items(spark, sf):
    return metrics.total_items(chosen(spark, sf))


@check(
    "overall_sentiment",
    sql(
        "SELECT game_name, overall_sentiment, count(*) AS number_of_items FROM items "
        f"WHERE {_RANGE} GROUP BY ALL"
    ),
)
def overall_sentiment(spark, sf):
    return metrics.overall_sentiment(chosen(spark, sf))


@check(
    "category_sentiment",
    sql(
        "SELECT game_name, category, "
        "count(*) FILTER (sentiment = 'positive') AS number_of_positive_items, "
        "count(*) FILTER (sentiment = 'negative') AS number_of_negative_items, "
        "count(*) FILTER (sentiment = 'neutral') AS number_of_neutral_items "
        f"FROM ({_RATED}) GROUP BY ALL"
    ),
)
def category_sentiment(spark, sf):
    return metrics.category_sentiment(rated(spark, sf))


_COUNTS = (
    "SELECT game_name, category, sub_category, sentiment, count(*) AS count "
    f"FROM ({_RATED}) GROUP BY ALL"
)


@check("subcategory_counts", sql(_COUNTS))
def subcategory_counts(spark, sf):
    return metrics.subcategory_counts(rated(spark, sf))


TOP = (
    f"SELECT *, CAST(row_number() OVER (PARTITION BY game_name, category ORDER BY count DESC, "
    f"sub_category, sentiment) AS INTEGER) AS rank FROM ({_COUNTS}) "
    "WHERE sentiment <> 'neutral' QUALIFY rank <= 5"
)


@check("top_subcategories", sql(f"{TOP} ORDER BY game_name, category, count DESC"))
def top_subcategories(spark, sf):
    top = metrics.top_subcategories(metrics.subcategory_counts(rated(spark, sf)))
    return top.orderBy("game_name", "category", F.desc("count"), "rank")


@check("distinct_game_sources", sql("SELECT DISTINCT game_name, content_type FROM items"))
def distinct_game_sources(spark, sf):
    return metrics.distinct_game_sources(views.items(spark, sf))


@check(
    "batch_profile",
    sql(
        "SELECT count(*) AS row_count, count(DISTINCT content_id) AS distinct_ids "
        "FROM second_delivery"
    ),
)
def batch_profile(spark, sf):
    return merge.batch_profile(views.second_delivery(spark, sf))


NEWEST = (
    "SELECT * FROM items {where} QUALIFY row_number() OVER (PARTITION BY game_name "
    "ORDER BY timestamp DESC, content_id) <= 10"
)


@check(
    "report_items",
    sql(
        "SELECT game_name, content_id, translated_content_text, content_type FROM ("
        + NEWEST.format(where=f"WHERE {_RANGE}")
        + ")"
    ),
)
def report_items(spark, sf):
    newest = reports.report_items(chosen(spark, sf))
    return newest.select("game_name", "content_id", "translated_content_text", "content_type")
