"""Every source onto the one feedback schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas


def pack_metadata(columns: Sequence[str]) -> Column:
    """Source-specific columns as one JSON text; empty fields are left out."""
    return F.to_json(F.struct(*columns))


def name_games(
    reviews: DataFrame, games: DataFrame | None = None, game_name: str | None = None
) -> DataFrame:
    """Add ``game_name``: the one given, or that of the app in ``games``, which
    then also says which apps to keep. With neither, the app id is the name."""
    if games is not None:
        return reviews.join(games.select("app_id", "game_name"), "app_id")
    name = F.col("app_id") if game_name is None else F.lit(game_name)
    return reviews.withColumn("game_name", name)


def unify_steam(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        F.col("recommendationid").alias("content_id"),
        F.lit(schemas.STEAM).alias("content_type"),
        "game_name",
        F.col("review").alias("content_text"),
        F.timestamp_seconds("timestamp_created").alias("timestamp"),
        F.col("author")["steamid"].alias("author_id"),
        pack_metadata(schemas.STEAM_METADATA).alias("content_metadata"),
    )


def unify_play(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        F.col("reviewId").alias("content_id"),
        F.lit(schemas.PLAY).alias("content_type"),
        "game_name",
        F.col("content").alias("content_text"),
        F.col("at").alias("timestamp"),
        F.col("userName").alias("author_id"),
        pack_metadata(schemas.PLAY_METADATA).alias("content_metadata"),
    )


def unify_forum(comments: DataFrame) -> DataFrame:
    """Comments with their post; the forum's name stands for the game."""
    return comments.select(
        F.col("comment_id").alias("content_id"),
        F.lit(schemas.FORUM).alias("content_type"),
        F.col("subreddit").alias("game_name"),
        F.col("body").alias("content_text"),
        F.col("created_utc").alias("timestamp"),
        F.col("author").alias("author_id"),
        pack_metadata(schemas.FORUM_METADATA).alias("content_metadata"),
    )


def conform(df: DataFrame, ddl: str = schemas.FEEDBACK) -> DataFrame:
    """Exactly the columns of ``ddl``, in order and cast; missing ones are an error."""
    schema = T.StructType.fromDDL(ddl)
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.to(schema)


def flatten_author(reviews: DataFrame, keep: Sequence[str] = ("recommendationid",)) -> DataFrame:
    """The author map as seven ``author_…`` columns, counts as numbers."""
    fields = []
    for field in schemas.AUTHOR_FIELDS:
        value = F.col("author")[schemas.AUTHOR_KEYS.get(field, field)]
        value = value if field == "steamid" else value.cast("long")
        fields.append(value.alias(f"author_{field}"))
    return reviews.select(*keep, *fields)
