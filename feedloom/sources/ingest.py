"""From landed files to feedback rows, by content type.

Nothing is cut unless asked: without a cap, a sample, languages or days, every
landed row is read. A landed folder may hold many deliveries of one review; the
newest edit of each is taken before any cap or sample.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import merge
from feedloom.operators.unify import conform, name_games, unify_forum, unify_play, unify_steam
from feedloom.plans.ranking import first_n
from feedloom.plans.staging import stage
from feedloom.sources import bounds, landed

Time = date | datetime


def ingest_steam(
    spark: SparkSession,
    path: str,
    *,
    app_id: str | None = None,
    game_name: str | None = None,
    games: DataFrame | None = None,
    cap: int | None = None,
    sample: int | None = None,
    asof: Time | None = None,
    days: int | None = None,
    until: Time | None = None,
) -> DataFrame:
    """Reviews of every app; with ``cap`` its newest ones, with ``sample`` so many of these."""
    reviews = name_games(_one_app(landed.read_steam(spark, path), app_id), games, game_name)
    created = F.timestamp_seconds("timestamp_created")
    reviews = _in_time(reviews, created, asof, days, until)
    edited = [F.col("timestamp_updated"), F.col("timestamp_created")]
    reviews = newest_edit(reviews, ["app_id"], "recommendationid", edited)
    if cap is not None:
        reviews = bounds.newest(reviews, ["app_id"], created, "recommendationid", cap)
    if sample is not None:
        reviews = bounds.sample_threshold(
            reviews, ["app_id"], "recommendationid", sample, capped=cap is not None
        )
    return conform(unify_steam(reviews))


def ingest_play(
    spark: SparkSession,
    path: str,
    *,
    app_id: str | None = None,
    game_name: str | None = None,
    games: DataFrame | None = None,
    cap: int | None = None,
    sample: int | None = None,
    languages: Sequence[str] | None = None,
    asof: Time | None = None,
    days: int | None = None,
    until: Time | None = None,
) -> DataFrame:
    """Reviews of every app. With ``cap`` the newest ones per app and language, pooled to
    ``cap``; with ``sample`` so many of these; with ``languages`` only those."""
    reviews = name_games(_one_app(landed.read_play(spark, path), app_id), games, game_name)
    reviews = _in_time(reviews, F.col("at"), asof, days, until)
    if languages is not None:
        reviews = reviews.where(F.col("language").isin(*languages))
    reviews = newest_edit(reviews, ["app_id"], "reviewId", [F.col("at"), F.col("repliedAt")])
    if cap is not None:
        reviews = bounds.newest_by_language(
            reviews, ["app_id"], F.col("at"), "reviewId", cap, languages=None
        )
        reviews = bounds.sample_languages(reviews, ["app_id"], "reviewId", cap, sample, capped=True)
    elif sample is not None:
        reviews = bounds.sample_threshold(reviews, ["app_id"], "reviewId", sample)
    return conform(unify_play(reviews))


def ingest_forum(
    spark: SparkSession,
    path: str,
    *,
    app_id: str | None = None,
    game_name: str | None = None,
    games: DataFrame | None = None,
    max_posts: int | None = None,
    max_comments: int | None = None,
    asof: Time | None = None,
    days: int | None = 365,
    until: Time | None = None,
) -> DataFrame:
    """Comments under posts of every forum; with ``max_posts`` under the best posts, with
    ``max_comments`` the best ones of each.

    ``app_id`` or ``games`` picks forums; the game is named after its forum, so
    ``game_name`` is accepted and not used. ``days`` counts only with ``asof``.
    """
    posts = landed.read_posts(spark, f"{path}/posts")
    if app_id is not None:
        posts = posts.where(F.col("subreddit") == app_id)
    if games is not None:
        forums = games.select(F.col("app_id").alias("subreddit"))
        posts = posts.join(forums, "subreddit", "left_semi")
    posts = _in_time(posts, F.col("created_utc"), asof, days, until)
    posts = newest_edit(posts, [], "id", [F.col("created_utc"), F.col("num_comments")])
    comments = landed.read_comments(spark, f"{path}/comments")
    comments = newest_edit(comments, ["post_id"], "comment_id", [F.col("created_utc")])
    if max_posts is not None:
        posts = bounds.top_posts(posts, max_posts)
    if max_comments is not None:
        comments = bounds.top_comments(comments, max_comments)
    return conform(unify_forum(landed.with_post(comments, posts)))


def newest_edit(
    rows: DataFrame, by: Sequence[str], id_col: str, times: Sequence[Column]
) -> DataFrame:
    """One row per id, the last by ``times``; rows without an id all stay, copies of them apart.

    Ids are counted first, a job that runs while the plan is made. Only rows of ids that come more than once
    are shuffled, unless these ids are too many to be broadcast; all others, texts and all, stay where they are read.
    """
    whole = F.to_json(F.struct(*rows.columns))
    own = F.when(F.col(id_col).isNull(), F.md5(whole))
    keyed = rows.withColumn("_own", own)
    keys = [*by, id_col, "_own"]
    order = [*[t.desc_nulls_last() for t in times], F.xxhash64(whole)]
    several = keyed.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    several = stage(several.select(*[F.col(k).alias(f"_known_{k}") for k in keys]), "several")
    n = several.count()
    if not n:
        return rows
    if n > merge.BROADCAST_KEYS:
        return first_n(keyed, keys, order, 1).drop("_own")
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    newest = first_n(keyed.join(F.broadcast(several), same, "left_semi"), keys, order, 1)
    return keyed.join(F.broadcast(several), same, "left_anti").unionByName(newest).drop("_own")


def _in_time(
    rows: DataFrame, time: Column, asof: Time | None, days: int | None, until: Time | None
) -> DataFrame:
    if asof is not None and days is not None:
        rows = bounds.within_days(rows, time, asof, days)
    return rows if until is None else rows.where(time <= F.lit(until).cast("timestamp"))


SOURCES = {
    schemas.STEAM: ingest_steam,
    schemas.PLAY: ingest_play,
    schemas.FORUM: ingest_forum,
    schemas.FORUM_ALIAS: ingest_forum,
}


def content_type_of(name: str) -> str:
    """The one name of a source; its alias is accepted, any other is an error."""
    if name not in SOURCES:
        raise ValueError(f"unknown content type {name!r}, expected one of {sorted(SOURCES)}")
    return schemas.FORUM if name == schemas.FORUM_ALIAS else name


def ingest(spark: SparkSession, content_type: str, path: str, **options: object) -> DataFrame:
    """Feedback rows of one source; no landed rows give an empty frame."""
    return SOURCES[content_type_of(content_type)](spark, path, **options)


def _one_app(reviews: DataFrame, app_id: str | None) -> DataFrame:
    """Reviews of one app; files outside ``app_id=…`` folders count as its own."""
    if app_id is None:
        return reviews
    own = F.col("app_id").isNull() | (F.col("app_id") == app_id)
    return reviews.where(own).withColumn("app_id", F.lit(app_id))
