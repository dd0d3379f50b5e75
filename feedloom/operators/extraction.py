"""Model answers as columns: parsed table, item table, topic table.

The selected columns are fixed values: they are those of tables other systems read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.functions.rows import row_by_row
from feedloom.operators.quality import VALID_OVERALL, expect_or_drop
from feedloom.schemas import CATEGORIES, extraction_ddl


def parse_extraction(
    extracted: DataFrame, categories: Sequence[str] = CATEGORIES, json_col: str = "content_topic"
) -> DataFrame:
    """Add ``answer``; broken JSON gives empty fields, not an error."""
    return extracted.withColumn("answer", F.from_json(json_col, extraction_ddl(categories)))


def parsed_wide(extracted: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Item columns, overall and summary, two columns per category, other topics."""
    per_category = []
    for category in categories:
        found = F.col("answer")[category]
        per_category.append(found["sentiment"].alias(category))
        per_category.append(found["sub_topic"].alias(f"{category}_sub_topic"))
    return parse_extraction(extracted, categories).select(
        "content_id",
        "game_name",
        "author_id",
        "content_text",
        "translated_content_text",
        "content_type",
        "timestamp",
        "answer.overall",
        "answer.summary",
        *per_category,
        "answer.other",
        "content_metadata",
    )


@row_by_row
def parsed(
    extracted: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    rules: Mapping[str, str] = VALID_OVERALL,
    observation: Observation | None = None,
) -> DataFrame:
    return expect_or_drop(parsed_wide(extracted, categories), rules, observation)


@row_by_row
def gold_items(parsed_rows: DataFrame) -> DataFrame:
    return parsed_rows.select(
        "content_id",
        "game_name",
        "content_text",
        "translated_content_text",
        "content_type",
        "author_id",
        "timestamp",
        F.col("overall").alias("overall_sentiment"),
        F.col("summary").alias("ai_summary"),
        "content_metadata",
    )


def _category_topics(categories: Sequence[str]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(category).alias("category"),
                F.col(category).alias("sentiment"),
                F.col(f"{category}_sub_topic").alias("sub_category"),
            )
            for category in categories
        ]
    )


def _other_topics() -> Column:
    return F.transform(
        "other",
        lambda entry: F.struct(
            F.lit("other").alias("category"),
            entry["sentiment"].alias("sentiment"),
            entry["topic"].alias("sub_category"),
        ),
    )


def _rated(topics: Column) -> Column:
    return F.filter(topics, lambda topic: topic["sentiment"].isNotNull())


def rated_topics(categories: Sequence[str] = CATEGORIES) -> Column:
    """All rated topics of a parsed row: an array of category, sentiment and sub-category."""
    return _rated(F.concat(_category_topics(categories), F.coalesce(_other_topics(), F.array())))


def _topic_rows(parsed_rows: DataFrame, rated: Column, carry: Sequence[str] = ()) -> DataFrame:
    return parsed_rows.select("content_id", "game_name", *carry, F.inline(rated))


def category_topics(parsed_rows: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """One row per item and rated category."""
    return _topic_rows(parsed_rows, _rated(_category_topics(categories)))


def other_topics(parsed_rows: DataFrame) -> DataFrame:
    """One row per rated free-form topic; an empty or missing list gives none."""
    return _topic_rows(parsed_rows, _rated(_other_topics()))


@row_by_row
def gold_topics(
    parsed_rows: DataFrame, categories: Sequence[str] = CATEGORIES, carry: Sequence[str] = ()
) -> DataFrame:
    """Category topics and free-form topics out of one read of the parsed rows, with the
    columns ``carry`` of their item."""
    return _topic_rows(parsed_rows, rated_topics(categories), carry)


def union_topics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Topic rows of two tables, duplicates kept."""
    return first.unionByName(second)


def unpack_metadata(
    df: DataFrame, fields: Mapping[str, str], column: str = "content_metadata"
) -> DataFrame:
    """Chosen metadata fields, name to type, as columns beside the id."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return df.withColumn("_meta", F.from_json(column, ddl)).select("content_id", "_meta.*")
