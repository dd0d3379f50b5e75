"""Whole runs: a new game beside known ones, and a refresh of all known ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check, views
from checks.report import REQUEST, rows_sql
from checks.stream import chain_on
from checks.views import plain, sql
from feedloom.operators import tables
from feedloom.plans import counts, runs
from feedloom.plans.staging import fresh_path
from feedloom.sources.ingest import ingest
from feedloom.streaming import chain as streams
from feedloom.streaming.upsert import upsert

_STEAM_ROWS = (
    "SELECT 's' || doc_id AS content_id, 'Steam Review' AS content_type, {name} AS game_name, "
    "text AS content_text, date_trunc('second', ts) AS timestamp, "
    "CAST(user_id AS VARCHAR) AS author_id, NULL AS content_metadata, event_type, lang FROM docs "
    "{where}"
)
_FORUM_ROWS = (
    "SELECT comment_id AS content_id, 'Reddit Comment' AS content_type, subreddit AS game_name, "
    "body AS content_text, created_utc AS timestamp, author AS author_id, NULL AS content_metadata, "
    "NULL AS event_type, NULL AS lang FROM post_comments"
)


def _outcome(spark, chain):
    """Items, topics per item and reports, as rows of one table."""
    items = tables.items_of(spark, chain.table(streams.ITEMS))
    topics = tables.items_of(spark, chain.table(streams.TOPICS))
    rows = items.select(
        F.lit("items").alias("table_name"),
        "game_name",
        F.col("content_id").alias("key"),
        F.col("overall_sentiment").alias("text"),
    )
    return rows.unionByName(
        topics.select(
            F.lit("topics").alias("table_name"),
            "game_name",
            F.col("content_id").alias("key"),
            F.concat_ws("/", "category", "sentiment", "sub_category").alias("text"),
        )
    )


_OUTCOME = (
    "SELECT 'items' AS table_name, game_name, content_id AS key, overall_sentiment AS text FROM items "
    "UNION ALL SELECT 'topics', game_name, content_id, "
    "concat_ws('/', category, sentiment, sub_category) FROM topics"
)


@check(
    "run_new_game",
    sql(
        f"{_OUTCOME} UNION ALL SELECT 'reports', game_name, persona, report_contents FROM "
        "(" + rows_sql("SELECT 'New Game' AS game_name") + ")",
        feedback=f"{views.VIEWS['feedback']} UNION ALL "
        + _STEAM_ROWS.format(name="'New Game'", where="WHERE source = 'src3'"),
    ),
)
def run_new_game(spark, sf):
    chain = chain_on(spark, "new_game")
    upsert(views.feedback(spark, sf), chain.table(streams.BRONZE))
    runs.run_new_game(
        spark,
        chain,
        "Steam Review",
        views.landed(spark, sf)["steam"],
        app_id="src3",
        game_name="New Game",
        request=REQUEST,
    )
    reports = spark.table(chain.table(streams.REPORTS)).select(
        F.lit("reports").alias("table_name"),
        "game_name",
        F.col("persona").alias("key"),
        F.col("report_contents").alias("text"),
    )
    return _outcome(spark, chain).unionByName(reports)


@check(
    "run_refresh",
    sql(
        _OUTCOME,
        feedback=_STEAM_ROWS.format(name="'Game of ' || source", where="")
        + f" UNION ALL {_FORUM_ROWS}",
    ),
)
def run_refresh(spark, sf):
    """Few rows of two sources are known; the third source must not be touched."""
    chain = chain_on(spark, "refreshed")
    paths = views.landed(spark, sf)
    paths = {"Steam Review": paths["steam"], "Google Play Review": paths["play"], "Reddit Comment": paths["forum"]}
    apps = views.apps(spark, sf)
    games = apps.withColumn("content_type", F.lit("Steam Review")).unionByName(
        apps.withColumn("content_type", F.lit("Google Play Review"))
    )
    known = ingest(spark, "Steam Review", paths["Steam Review"], games=apps, cap=3)
    known = known.unionByName(ingest(spark, "Reddit Comment", paths["Reddit Comment"], max_comments=1))
    upsert(known, chain.table(streams.BRONZE))
    runs.run_refresh(spark, chain, paths, games)
    return _outcome(spark, chain)


@check("run_refresh_alias", sql(_OUTCOME, feedback=_FORUM_ROWS))
def run_refresh_alias(spark, sf):
    """One comment of each post is known; the forum is named by its alias, and refreshed twice."""
    chain = chain_on(spark, "aliased")
    forum = views.landed(spark, sf)["forum"]
    upsert(ingest(spark, "Reddit Post", forum, max_comments=1), chain.table(streams.BRONZE))
    games = spark.createDataFrame([], "content_type string, app_id string, game_name string")
    for _ in range(2):
        runs.run_refresh(spark, chain, {"Reddit Post": forum}, games)
    return _outcome(spark, chain)


@check(
    "run_refresh_landed",
    sql(
        f"SELECT * FROM ({_OUTCOME}) WHERE table_name = 'items'",
        feedback=_STEAM_ROWS.format(name="'Game of ' || source", where=""),
    ),
)
def run_refresh_landed(spark, sf):
    """Review files are read as they land: half of the apps' folders, then the others."""
    chain = chain_on(spark, "as_landed")
    games = views.apps(spark, sf).withColumn("content_type", F.lit("Steam Review"))
    known = ingest(spark, "Steam Review", views.landed(spark, sf)["steam"], games=games, cap=1)
    upsert(known, chain.table(streams.BRONZE))
    pages = spark.read.text(views.landed(spark, sf)["steam"])
    path = fresh_path(spark, "landing")
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part in (first, ~first):
        pages.where(part).write.mode("append").option("compression", "gzip").partitionBy("app_id").text(path)
        runs.run_refresh(spark, chain, {"Steam Review": path}, games)
    return _outcome(spark, chain).where("table_name = 'items'")


@check("run_refresh_forum", sql(_OUTCOME, feedback=_FORUM_ROWS))
def run_refresh_forum(spark, sf):
    """Comments land before their posts, those of half the forums before any refresh knows of these."""
    chain = chain_on(spark, "forum_as_landed")
    whole = views.landed(spark, sf)["forum"]
    posts, comments = (spark.read.json(f"{whole}/{name}") for name in ("posts", "comments"))
    path = fresh_path(spark, "landing")
    games = spark.createDataFrame([], "content_type string, app_id string, game_name string")
    late = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    some = F.pmod(F.xxhash64("subreddit"), F.lit(2)) == 0
    known = ingest(spark, "Reddit Comment", whole, max_comments=1)
    upsert(known.where(F.pmod(F.xxhash64("game_name"), F.lit(2)) == 0), chain.table(streams.BRONZE))
    early = F.pmod(F.xxhash64("comment_id"), F.lit(3)) > 0
    deliveries = ((posts.where(~late), comments.where(early)), (posts.where(late & some), comments.where(~early)), (posts.where(late & ~some), None))
    for new_posts, new_comments in deliveries:
        new_posts.write.mode("append").option("compression", "gzip").json(f"{path}/posts")
        if new_comments is not None:
            new_comments.write.mode("append").option("compression", "gzip").json(f"{path}/comments")
        runs.run_refresh(spark, chain, {"Reddit Comment": path}, games)
        upsert(known, chain.table(streams.BRONZE))  # from the second refresh on all forums are known
    streams.refresh(spark, chain)
    return _outcome(spark, chain)


@check(
    "report_rows_incremental",
    sql(
        rows_sql(),
        feedback=f"SELECT * FROM ({views.VIEWS['feedback']}) WHERE game_name <> 'src3' "
        "OR timestamp >= TIMESTAMP '2024-01-02 12:00:00'",
    ),
)
def report_rows_incremental(spark, sf):
    """Two deliveries, a game deleted between them, batches merged: reports out of counts kept by batch.

    Of the deleted game only what came later is known.
    """
    chain = chain_on(spark, "counted_by_day")
    for part in ("timestamp < timestamp'2024-01-02 12:00:00'", "timestamp >= timestamp'2024-01-02 12:00:00'"):
        upsert(views.feedback(spark, sf).where(part), chain.table(streams.BRONZE))
        streams.refresh(spark, chain)
        read = counts.update_counts(spark, chain)
        if part.startswith("timestamp <"):
            tables.delete_game(spark, tables.tables_with_games(spark, chain.database), "src3")
    tables.compact(spark, chain.table(streams.PARSED), 1)
    again = counts.update_counts(spark, chain)
    if (len(read), len(again)) != (1, 0):
        raise AssertionError(f"one new batch was to be read, then none, not {read} and {again}")
    of = [spark.table(chain.table(name)) for name in (counts.COUNTS, counts.LATEST)]
    built = counts.build_reports_from_counts(*of, REQUEST)
    return plain(built)
