"""The two ways the whole flow is run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.metrics import distinct_game_sources
from feedloom.operators.tables import create_item_table, items_of, save_reports
from feedloom.operators.unify import conform, name_games, unify_forum, unify_play, unify_steam
from feedloom.plans.reports import Request, build_reports_from_parsed
from feedloom.plans.staging import folder_exists, scratch, stage
from feedloom.sources import landed
from feedloom.sources.ingest import content_type_of, ingest
from feedloom.streaming.chain import BRONZE, PARSED, REPORTS, Chain, checkpoints_of, refresh
from feedloom.streaming.forum import join_landed
from feedloom.streaming.upsert import upsert, upsert_stream

Options = Mapping[str, Mapping[str, object]]


def run_new_game(
    spark: SparkSession,
    chain: Chain,
    content_type: str,
    path: str,
    *,
    app_id: str,
    game_name: str,
    request: Request,
    **options: object,
) -> None:
    """Ingest one source of one game, enrich what is new, report on the game.

    ``request`` says for which days and readers; its game is this one.
    """
    own = content_type_of(content_type)
    with scratch(spark):
        rows = ingest(spark, own, path, app_id=app_id, game_name=game_name, **options)
        upsert(rows, chain.table(BRONZE), chain.keys)
    refresh(spark, chain)
    # A forum names its game after itself.
    game = app_id if own == schemas.FORUM else game_name
    write_reports(spark, chain, replace(request, update_type="NEW_GAME", game_name=game))


def run_refresh(
    spark: SparkSession,
    chain: Chain,
    paths: Mapping[str, str],
    games: DataFrame,
    options: Options | None = None,
) -> None:
    """Ingest every known game again, from the sources it came from, and enrich.

    ``paths`` gives the landed files per content type, ``games`` the app id of
    each game (``content_type``, ``app_id``, ``game_name``), ``options`` what a
    source is to be ingested with. All games of a source are read in one job. Files
    of a source without options are read once: later runs read what
    landed since, and only a game that is new to them reads what landed before. A comment that
    lands before its post waits for it.

    A known source without a path, or a known game without an app id, is an error
    before anything is read.
    """
    paths = {content_type_of(name): path for name, path in paths.items()}
    options = {content_type_of(name): chosen for name, chosen in (options or {}).items()}
    create_item_table(spark, chain.table(BRONZE), schemas.FEEDBACK)
    with scratch(spark):
        known = distinct_game_sources(items_of(spark, chain.table(BRONZE)))
        _check(known, paths, games)
        for content_type, path in paths.items():
            own = known.where(F.col("content_type") == content_type).select("game_name")
            if content_type == schemas.FORUM:
                apps = own.select(F.col("game_name").alias("app_id"), "game_name")
            else:
                listed = games.where(F.col("content_type") == content_type)
                apps = listed.join(own, "game_name", "left_semi").select("app_id", "game_name")
            chosen = options.get(content_type, {})
            if chosen:
                rows = ingest(spark, content_type, path, games=apps, **chosen)
                upsert(rows, chain.table(BRONZE), chain.keys)
            else:
                _upsert_landed(spark, chain, content_type, path, apps)
    refresh(spark, chain)


_REVIEWS = {
    schemas.STEAM: (landed.read_steam, unify_steam),
    schemas.PLAY: (landed.read_play, unify_play),
}
# Up to so many games that are new to a source are named in its scan, which then skips other games' folders.
MAX_NAMED_GAMES = 1000


def _upsert_landed(
    spark: SparkSession, chain: Chain, content_type: str, path: str, apps: DataFrame
) -> None:
    """Upsert what has landed since the last run over the same folder.

    The games of the last run are written down once it has ended. Others have missed what landed before
    and get all of it, without a second read for the games that were there. If nothing is
    written down though a run began, all are read again, which adds nothing twice.
    """
    table = chain.table(BRONZE)
    folder = f"{checkpoints_of(spark, chain)}/landed-{md5(f'{content_type} {path}'.encode()).hexdigest()[:12]}"
    apps = stage(apps, "apps")
    if folder_exists(spark, folder):
        games = f"{folder}/games"
        new = apps
        if folder_exists(spark, games):
            new = apps.exceptAll(spark.read.schema(apps.schema).parquet(games).distinct())
        new = stage(new, "new-games")
        names = [row["app_id"] for row in new.select("app_id").distinct().limit(MAX_NAMED_GAMES + 1).collect()]
        if names:
            upsert(_landed_before(spark, content_type, path, new, names), table, chain.keys)
    if content_type == schemas.FORUM:

        def take(comments: DataFrame) -> None:
            known = apps.select(F.col("app_id").alias("subreddit"))
            upsert(conform(unify_forum(comments.join(known, "subreddit", "left_semi"))), table, chain.keys)

        join_landed(spark, path, folder, take)
    else:
        read, unify = _REVIEWS[content_type]
        rows = conform(unify(name_games(read(spark, path, stream=True), apps)))
        upsert_stream(rows, table, f"{folder}/reviews", chain.keys, by_game=landed.by_app(spark, path))
    apps.write.mode("overwrite").parquet(f"{folder}/games")


def _landed_before(
    spark: SparkSession, content_type: str, path: str, games: DataFrame, names: Sequence[str]
) -> DataFrame:
    if content_type == schemas.FORUM:
        return ingest(spark, content_type, path, games=games)
    read, unify = _REVIEWS[content_type]
    rows = read(spark, path)
    if len(names) <= MAX_NAMED_GAMES:
        rows = rows.where(F.col("app_id").isin(*names))
    return conform(unify(name_games(rows, games)))


def _check(known: DataFrame, paths: Mapping[str, str], games: DataFrame) -> None:
    sources = {row["content_type"] for row in known.select("content_type").distinct().limit(100).collect()}
    missing = sorted(str(s) for s in sources - set(paths))
    if missing:
        raise ValueError(f"no path for known content types: {', '.join(missing)}")
    listed = games.select("content_type", "game_name")
    unlisted = known.where(F.col("content_type") != schemas.FORUM)
    unlisted = unlisted.join(listed, ["content_type", "game_name"], "left_anti").limit(10).collect()
    if unlisted:
        named = sorted(f"{row['game_name']} ({row['content_type']})" for row in unlisted)
        raise ValueError(f"no app id for known games, among them: {', '.join(named)}")


def write_reports(spark: SparkSession, chain: Chain, request: Request) -> None:
    """Build reports out of the parsed table and save them."""
    with scratch(spark):
        parsed = items_of(spark, chain.table(PARSED))
        reports = build_reports_from_parsed(parsed, request, chain.categories)
        save_reports(reports, chain.table(REPORTS), request.update_type)
