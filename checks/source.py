"""Sources, bounded reads and the mapping onto one schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import check, views
from checks.views import landed, plain, sql
from feedloom.operators import unify
from feedloom.operators.merge import batch_profile
from feedloom.operators.metrics import distinct_games
from feedloom.plans.staging import fresh_path
from feedloom.sources import bounds
from feedloom.sources import landed as files
from feedloom.sources.ingest import ingest
from feedloom.sources.kept import KeptSample

_STEAM = (
    "source AS app_id, 's' || doc_id AS recommendationid, text AS review, "
    "CAST(user_id AS VARCHAR) AS steamid, k AS comment_count, lang AS language, "
    "event_type = 'click' AS received_for_free, event_type = 'purchase' AS steam_purchase, "
    "seconds AS timestamp_created, seconds + k AS timestamp_updated, quality = 1 AS voted_up, "
    "user_id AS votes_funny, n_chars AS votes_up, "
    "CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) AS weighted_vote_score, "
    "false AS written_during_early_access, CAST(NULL AS BOOLEAN) AS primarily_steam_deck"
)
_PLAY = (
    "'p' || doc_id AS \"reviewId\", 'user ' || user_id AS \"userName\", "
    "'https://example.com/' || user_id AS \"userImage\", text AS content, "
    "CAST(1 + k % 5 AS INTEGER) AS score, n_chars AS \"thumbsUpCount\", "
    "'1.' || k AS \"reviewCreatedVersion\", ts AS at, "
    "CASE WHEN event_type = 'error' THEN 'sorry' END AS \"replyContent\", "
    "CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 DAY END AS \"repliedAt\", "
    "'2.' || k AS \"appVersion\", lang AS language, source AS app_id"
)


@check("src_steam", sql(f"SELECT {_STEAM} FROM docs"))
def src_steam(spark, sf):
    reviews = files.read_steam(spark, landed(spark, sf)["steam"])
    return reviews.withColumn("steamid", F.col("author")["steamid"]).drop("author")


@check("src_play", sql(f"SELECT {_PLAY} FROM docs"))
def src_play(spark, sf):
    return plain(files.read_play(spark, landed(spark, sf)["play"]))


@check("src_reddit_posts", sql("SELECT * FROM posts"))
def src_reddit_posts(spark, sf):
    return plain(files.read_posts(spark, landed(spark, sf)["forum"] + "/posts"))


def _post_comments(spark, sf):
    forum = landed(spark, sf)["forum"]
    posts = files.read_posts(spark, f"{forum}/posts")
    return files.with_post(files.read_comments(spark, f"{forum}/comments"), posts)


@check("src_reddit_comments", sql("SELECT * FROM post_comments"))
def src_reddit_comments(spark, sf):
    return plain(_post_comments(spark, sf))


_TOP = (
    "SELECT c.* FROM (SELECT *, row_number() OVER (PARTITION BY post_id "
    "ORDER BY score DESC, comment_id) AS r FROM post_comments) c JOIN (SELECT *, row_number() "
    "OVER (PARTITION BY subreddit ORDER BY score DESC, id) AS r FROM posts) p "
    "ON p.id = c.post_id WHERE c.r <= {comments} AND p.r <= {posts}"
)


@check(
    "src_dispatch",
    sql(
        "SELECT 'Steam Review' AS content_type, 's' || doc_id AS content_id, "
        "'Game of ' || source AS game_name, text AS content_text FROM docs UNION ALL "
        "SELECT 'Google Play Review', 'p' || doc_id, source, text FROM docs UNION ALL "
        "SELECT 'Reddit Comment', comment_id, subreddit, body FROM post_comments"
    ),
)
def src_dispatch(spark, sf):
    """Every landed row of every source."""
    paths = landed(spark, sf)
    found = ingest(spark, "Steam Review", paths["steam"], games=views.apps(spark, sf))
    found = found.unionByName(ingest(spark, "Google Play Review", paths["play"]))
    found = found.unionByName(ingest(spark, "Reddit Post", paths["forum"]))
    return found.select("content_type", "content_id", "game_name", "content_text")


@check(
    "ingest_capped",
    sql(
        "SELECT content_id, game_name FROM (SELECT 's' || doc_id AS content_id, source AS game_name "
        "FROM docs QUALIFY row_number() OVER (PARTITION BY source ORDER BY seconds DESC, 's' || doc_id) "
        "<= 30) QUALIFY row_number() OVER (PARTITION BY game_name "
        "ORDER BY md5('sample' || content_id), content_id) <= 20 UNION ALL "
        "SELECT 'p' || doc_id, source FROM docs WHERE lang IN ('de', 'en') QUALIFY row_number() "
        "OVER (PARTITION BY source ORDER BY md5('sample' || 'p' || doc_id), 'p' || doc_id) <= 15 UNION ALL "
        f"SELECT comment_id, subreddit FROM ({_TOP.format(posts=4, comments=3)})"
    ),
)
def ingest_capped(spark, sf):
    """Caps, samples and languages as asked."""
    paths = landed(spark, sf)
    found = ingest(spark, "Steam Review", paths["steam"], cap=30, sample=20)
    play = ingest(spark, "Google Play Review", paths["play"], sample=15, languages=("de", "en"))
    forum = ingest(spark, "Reddit Comment", paths["forum"], max_posts=4, max_comments=3)
    return found.unionByName(play).unionByName(forum).select("content_id", "game_name")


@check(
    "ingest_redelivered",
    sql(
        "SELECT 's' || doc_id AS content_id, source AS game_name, count(*) AS row_count FROM "
        "(SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY source "
        "ORDER BY seconds DESC, 's' || doc_id) <= 30) GROUP BY ALL"
    ),
)
def ingest_redelivered(spark, sf):
    """The same reviews landed three times, then capped."""
    pages = spark.read.text(landed(spark, sf)["steam"])
    path = fresh_path(spark, "redelivered")
    for _ in range(3):
        pages.write.mode("append").option("compression", "gzip").partitionBy("app_id").text(path)
    found = ingest(spark, "Steam Review", path, cap=30)
    return found.groupBy("content_id", "game_name").agg(F.count("*").alias("row_count"))


@check(
    "cap_newest",
    sql(
        f"SELECT {_STEAM} FROM docs QUALIFY row_number() OVER (PARTITION BY source "
        "ORDER BY seconds DESC, 's' || doc_id) <= 30"
    ),
)
def cap_newest(spark, sf):
    reviews = src_steam(spark, sf)
    created = F.timestamp_seconds("timestamp_created")
    return bounds.newest(reviews, ["app_id"], created, "recommendationid", 30)


@check(
    "cap_newest_by_language",
    sql(
        "SELECT source AS app_id, lang AS language, 'p' || doc_id AS review_id, ts AS at FROM docs "
        "WHERE lang IN ('en', 'fr', 'es', 'ja', 'ko', 'zh', 'pt', 'hi') QUALIFY row_number() "
        "OVER (PARTITION BY source, lang ORDER BY ts DESC, 'p' || doc_id) <= 6"
    ),
)
def cap_newest_by_language(spark, sf):
    reviews = files.read_play(spark, landed(spark, sf)["play"])
    capped = bounds.newest_by_language(reviews, ["app_id"], F.col("at"), "reviewId", 6)
    return plain(capped.select("app_id", "language", F.col("reviewId").alias("review_id"), "at"))


@check(
    "topk_nested",
    sql(f"SELECT * EXCLUDE (r) FROM ({_TOP.format(posts=4, comments=3)})"),
)
def topk_nested(spark, sf):
    forum = landed(spark, sf)["forum"]
    posts = bounds.top_posts(files.read_posts(spark, f"{forum}/posts"), 4)
    comments = bounds.top_comments(files.read_comments(spark, f"{forum}/comments"), 3)
    return plain(files.with_post(comments, posts))


@check(
    "read_recent_days",
    sql(
        f"SELECT {_STEAM} FROM docs WHERE seconds >= "
        "epoch(TIMESTAMP '2024-01-04' - INTERVAL 2 DAY)"
    ),
)
def read_recent_days(spark, sf):
    created = F.timestamp_seconds("timestamp_created")
    return bounds.within_days(src_steam(spark, sf), created, datetime(2024, 1, 4), 2)


@check(
    "src_empty",
    sql(
        "SELECT count(*) AS row_count, count(DISTINCT content_id) AS distinct_ids, "
        "7 AS column_count FROM feedback WHERE game_name = 'no such app'"
    ),
)
def src_empty(spark, sf):
    none = ingest(spark, "Steam Review", landed(spark, sf)["steam"], app_id="no such app")
    return batch_profile(none).withColumn("column_count", F.lit(len(none.columns)))


@check(
    "unify_steam",
    sql(
        "SELECT 's' || doc_id AS content_id, 'Steam Review' AS content_type, source AS game_name, "
        "text AS content_text, date_trunc('second', ts) AS timestamp, "
        "CAST(user_id AS VARCHAR) AS author_id FROM docs"
    ),
)
def unify_steam(spark, sf):
    reviews = files.read_steam(spark, landed(spark, sf)["steam"])
    return plain(unify.unify_steam(unify.name_games(reviews)).drop("content_metadata"))


@check(
    "unify_play",
    sql(
        "SELECT 'p' || doc_id AS content_id, 'Google Play Review' AS content_type, "
        "'Game of ' || source AS game_name, text AS content_text, ts AS timestamp, "
        "'user ' || user_id AS author_id FROM docs"
    ),
)
def unify_play(spark, sf):
    reviews = files.read_play(spark, landed(spark, sf)["play"])
    named = unify.name_games(reviews, views.apps(spark, sf))
    return plain(unify.unify_play(named).drop("content_metadata"))


@check(
    "unify_reddit",
    sql(
        "SELECT comment_id AS content_id, 'Reddit Comment' AS content_type, subreddit AS game_name, "
        "body AS content_text, created_utc AS timestamp, author AS author_id FROM post_comments"
    ),
)
def unify_reddit(spark, sf):
    return plain(unify.unify_forum(_post_comments(spark, sf)).drop("content_metadata"))


@check(
    "pack_metadata",
    sql(
        "SELECT 's' || doc_id AS content_id, CAST(user_id AS VARCHAR) AS author, lang AS language, "
        "CAST(k AS VARCHAR) AS number, CAST(quality = 1 AS VARCHAR) AS vote, "
        "CAST(NULL AS VARCHAR) AS reply, CAST(11 + (quality IS NOT NULL)::INT AS INTEGER) AS fields "
        "FROM docs UNION ALL SELECT 'p' || doc_id, NULL, NULL, CAST(n_chars AS VARCHAR), "
        "CAST(1 + k % 5 AS VARCHAR), CASE WHEN event_type = 'error' THEN strftime(ts + INTERVAL 1 "
        "DAY, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END, CASE WHEN event_type = 'error' THEN 7 ELSE 5 END "
        "FROM docs UNION ALL SELECT comment_id, post_id, post_title, CAST(score AS VARCHAR), NULL, "
        "post_text, 4 FROM post_comments"
    ),
)
def pack_metadata(spark, sf):
    paths = landed(spark, sf)
    steam = unify.unify_steam(unify.name_games(files.read_steam(spark, paths["steam"])))
    play = unify.unify_play(unify.name_games(files.read_play(spark, paths["play"])))
    forum = unify.unify_forum(_post_comments(spark, sf))

    def fields(df, **names):
        found = {
            alias: F.get_json_object("content_metadata", f"$.{name}") if name else F.lit(None).cast("string")
            for alias, name in names.items()
        }
        count = F.size(F.json_object_keys("content_metadata")).alias("fields")
        return df.select("content_id", *[c.alias(a) for a, c in found.items()], count)

    result = fields(
        steam, author="author.steamid", language="language", number="comment_count",
        vote="voted_up", reply=None,
    )
    result = result.unionByName(
        fields(play, author=None, language=None, number="thumbsUpCount", vote="score", reply="repliedAt")
    )
    return result.unionByName(
        fields(forum, author="post_id", language="post_title", number="score", vote=None, reply="post_text")
    )


@check(
    "conform_unified",
    sql(
        "SELECT content_id, content_type, game_name, content_text, timestamp, author_id, "
        "content_metadata FROM feedback"
    ),
)
def conform_unified(spark, sf):
    wide = views.feedback(spark, sf).withColumn("more", F.lit(1))
    shuffled = wide.select(*sorted(wide.columns, reverse=True))
    return plain(unify.conform(shuffled.withColumn("author_id", F.col("author_id").cast("long"))))


@check(
    "flatten_author",
    sql(
        "SELECT 's' || doc_id AS recommendationid, CAST(user_id AS VARCHAR) AS author_steamid, "
        "k AS author_num_reviews, CAST(NULL AS BIGINT) AS author_num_games_owned, "
        "seconds AS author_last_played, n_chars AS author_playtime_forever, "
        "CAST(NULL AS BIGINT) AS author_playtime_at_review, "
        "CAST(NULL AS BIGINT) AS author_playtime_at_last_two_weeks FROM docs"
    ),
)
def flatten_author(spark, sf):
    return unify.flatten_author(files.read_steam(spark, landed(spark, sf)["steam"]))


@check(
    "search_catalogue",
    sql("SELECT page_id AS appid, url AS name FROM pages WHERE contains(lower(url), 'example.com')"),
)
def search_catalogue(spark, sf):
    pages = views.table(spark, sf, "pages")
    apps = pages.select(F.col("page_id").alias("appid"), F.col("url").alias("name"))
    nameless = apps.select(F.lit(None).cast("long").alias("appid"), "name")
    return bounds.search_catalogue(apps.unionByName(nameless), "Example.COM")


@check(
    "filter_rating",
    sql(f"SELECT {_PLAY} FROM docs WHERE 1 + k % 5 = 5 AND lang = 'en'"),
)
def filter_rating(spark, sf):
    reviews = files.read_play(spark, landed(spark, sf)["play"])
    return plain(bounds.with_rating(reviews, 5, "en"))


@check(
    "sample_threshold",
    sql(
        "SELECT content_id, game_name FROM feedback QUALIFY row_number() OVER (PARTITION BY "
        "game_name ORDER BY md5('sample' || content_id), content_id) <= 20"
    ),
)
def sample_threshold(spark, sf):
    rows = views.feedback(spark, sf).select("content_id", "game_name")
    return bounds.sample_threshold(rows, ["game_name"], "content_id", 20)


@check(
    "sample_merged",
    sql(
        "SELECT content_id, game_name FROM feedback QUALIFY row_number() OVER (PARTITION BY "
        "game_name ORDER BY md5('sample' || content_id), content_id) <= 20"
    ),
)
def sample_merged(spark, sf):
    """Three deliveries that overlap, each met by the kept sample alone: as one draw over all."""
    kept = KeptSample(spark, fresh_path(spark, "kept-sample"), ["game_name"], "content_id", 20)
    for part in (
        "timestamp < timestamp'2024-01-02 00:00:00'",
        "timestamp BETWEEN timestamp'2024-01-01 12:00:00' AND timestamp'2024-01-02 12:00:00'",
        "timestamp > timestamp'2024-01-02 06:00:00'",
    ):
        kept.extend(views.feedback(spark, sf).where(part))
    return kept.rows().select("content_id", "game_name")


@check(
    "sample_pooled_languages",
    sql(
        "SELECT content_id, game_name, lang AS language FROM (SELECT * FROM feedback QUALIFY "
        "row_number() OVER (PARTITION BY game_name ORDER BY md5('pool' || content_id), content_id) "
        "<= 40) QUALIFY row_number() OVER (PARTITION BY game_name "
        "ORDER BY md5('sample' || content_id), content_id) <= 20"
    ),
)
def sample_pooled_languages(spark, sf):
    language = F.get_json_object("content_metadata", "$.language").alias("language")
    rows = views.feedback(spark, sf).select("content_id", "game_name", language)
    return bounds.sample_languages(rows, ["game_name"], "content_id", 40, 20)


@check("distinct_games", sql("SELECT DISTINCT game_name FROM items"))
def games(spark, sf):
    return distinct_games(views.items(spark, sf))
