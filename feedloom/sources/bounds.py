"""Bounded reads: recency, newest-first caps, best posts, samples, ratings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.plans.ranking import first_n


def within_days(df: DataFrame, time: Column, asof: date | datetime, days: int) -> DataFrame:
    """Rows from the last ``days`` days before ``asof``."""
    since = F.lit(asof).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return df.where(time >= since)


def newest(df: DataFrame, by: Sequence[str], time: Column, id_col: str, n: int = 10_000) -> DataFrame:
    """At most ``n`` newest rows per group; ties go to the smaller id."""
    order = [time.desc_nulls_last(), F.col(id_col)]
    return first_n(df, by, order, n, slice_on=id_col, bucket=hours_back(time))


def hours_back(time: Column) -> Column:
    """Whole hours, counted backwards; a missing time is the oldest."""
    return F.coalesce(-F.floor(F.unix_seconds(time) / 3600), F.lit(2**62))


def newest_by_language(
    df: DataFrame,
    by: Sequence[str],
    time: Column,
    id_col: str,
    n: int = 10_000,
    languages: Sequence[str] | None = schemas.PLAY_LANGUAGES,
) -> DataFrame:
    """At most ``n`` newest rows for each group and language; of all languages if none are named."""
    known = df if languages is None else df.where(F.col("language").isin(*languages))
    return newest(known, [*by, "language"], time, id_col, n)


def top_posts(posts: DataFrame, n: int = 500) -> DataFrame:
    best = [F.col("score").desc_nulls_last(), F.col("id")]
    points_lost = F.coalesce(-F.col("score").cast("long"), F.lit(2**62))
    return first_n(posts, ["subreddit"], best, n, slice_on="id", bucket=points_lost)


def top_comments(comments: DataFrame, n: int = 20) -> DataFrame:
    """Best comments of every post; each task sends at most ``n`` per post."""
    best = [F.col("score").desc_nulls_last(), F.col("comment_id")]
    return first_n(comments, ["post_id"], best, n)


def sample_threshold(
    df: DataFrame,
    by: Sequence[str],
    id_col: str,
    n: int = 2000,
    seed: str = "sample",
    capped: bool = False,
) -> DataFrame:
    """All rows of a group of up to ``n``, else exactly ``n`` picked uniformly.

    Rows are drawn in the order of a seeded hash of the id, so that a rerun or
    a lost executor draws the same ones. The bit length of the hash grows along
    that order and halves the group with every step, which is what lets
    :func:`first_n` leave all but about ``2 n`` rows of a group unmoved. Groups
    that are ``capped`` already are ranked as they are, without that extra read.
    """
    draw = F.md5(F.concat(F.lit(seed), F.col(id_col)))
    order = [draw, F.col(id_col)]
    if capped:
        return first_n(df, by, order, n)
    bits = F.length(F.bin(F.conv(F.substring(draw, 1, 15), 16, 10).cast("long")))
    return first_n(df, by, order, n, slice_on=id_col, bucket=F.coalesce(bits, F.lit(0)))


def sample_languages(
    df: DataFrame,
    by: Sequence[str],
    id_col: str,
    pool: int = 10_000,
    n: int | None = 2000,
    capped: bool = False,
) -> DataFrame:
    """Pool all languages, cut to ``pool`` and then to ``n``; shares hold on average."""
    pooled = sample_threshold(df, by, id_col, pool, seed="pool", capped=capped)
    return pooled if n is None else sample_threshold(pooled, by, id_col, n, capped=True)


def with_rating(reviews: DataFrame, score: int, language: str) -> DataFrame:
    return reviews.where((F.col("score") == score) & (F.col("language") == language))


def search_catalogue(apps: DataFrame, term: str, id_col: str = "appid", name_col: str = "name") -> DataFrame:
    """Apps whose name holds ``term`` in any case; entries without an id are left out."""
    has_id = F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != "")
    return apps.where(has_id & F.lower(name_col).contains(term.lower()))
