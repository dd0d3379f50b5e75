"""Counts that reports are made of, kept per batch, game and day.

Each batch of the parsed table is counted once. Counts of batches add up, so reports read counts and never an item;
those of a game leave with its partitions. When small batches of the parsed table were merged,
their counts are added up under the merged batch's name, without reading it again. The newest
items of each day are kept beside the counts: the newest of a range are among them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import tables
from feedloom.operators.extraction import rated_topics
from feedloom.operators.tables import create_item_table, drop_batches, merged_from, write_batches
from feedloom.plans import reports
from feedloom.plans.ranking import first_n
from feedloom.plans.staging import scratch, stage
from feedloom.schemas import CATEGORIES
from feedloom.streaming.chain import PARSED, REPORTS, Chain

COUNTS = "feedback_content_counts"
LATEST = "feedback_content_latest"
# Items of a day that are kept for each game and batch: a report can list so many.
KEPT = 10

# ``at_midnight``: items of the very beginning of a day, which also belong to a range that ends with it.
_DAY = "day date, at_midnight boolean"
_COUNTS = f"{_DAY}, kind string, category string, sub_category string, sentiment string, count long"
_LATEST = f"{_DAY}, content_id string, content_type string, translated_content_text string, timestamp timestamp"
_BY = ["batch_id", "game_name", "day", "at_midnight"]


def _days() -> dict[str, Column]:
    day = F.to_date("timestamp")
    return {"day": day, "at_midnight": F.col("timestamp") == day.cast("timestamp")}


def partial_counts(parsed: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Items by sentiment, and topics, of ``parsed`` rows with their ``batch_id``: counted where they are read."""
    none = F.lit(None).cast("string")
    item = F.struct(F.lit("overall").alias("kind"), none.alias("category"), F.col("overall").alias("sentiment"), none.alias("sub_category"))
    topics = F.transform(
        rated_topics(categories),
        lambda t: F.struct(F.lit("topic").alias("kind"), t["category"].alias("category"), t["sentiment"].alias("sentiment"), t["sub_category"].alias("sub_category")),
    )
    rows = parsed.withColumns(_days()).select(*_BY, F.inline(F.concat(F.array(item), topics)))
    return rows.groupBy(*_BY, "kind", "category", "sub_category", "sentiment").agg(F.count("*").alias("count"))


def latest_items(parsed: DataFrame, n: int = KEPT) -> DataFrame:
    """The ``n`` newest items of each batch, game and day."""
    rows = parsed.where("timestamp IS NOT NULL").withColumns(_days())
    rows = rows.select(*_BY, "content_id", "content_type", "translated_content_text", "timestamp")
    return first_n(rows, _BY, [F.desc("timestamp"), F.col("content_id")], n)


def update_counts(spark: SparkSession, chain: Chain) -> list[str]:
    """Bring counts and latest items up to date with the parsed table; the batches that were read.

    To be called when no stream is running. Batches that are counted already are not read, those that
    are gone, wholly or for a game, leave the counts too.
    """
    parsed, counts, latest = (chain.table(name) for name in (PARSED, COUNTS, LATEST))
    create_item_table(spark, counts, _COUNTS)
    create_item_table(spark, latest, _LATEST)
    present, have = tables.batches(spark, parsed), tables.batches(spark, counts)
    with scratch(spark):
        unread = []
        for name in sorted(present - have):
            parts = merged_from(spark, parsed, name)
            if parts and set(parts) <= have:
                _add_up(spark, parsed, counts, latest, name, parts)
            else:
                unread.append(name)
        if unread:
            # ``isin`` of batches: only their partitions are read.
            rows = spark.table(parsed).where(F.col("batch_id").isin(unread))
            write_batches(latest_items(rows), latest)
            write_batches(partial_counts(rows, chain.categories), counts)
    for table in (latest, counts):
        drop_batches(spark, table, tables.missing_partitions(spark, table, parsed))
    return unread


def _add_up(spark: SparkSession, parsed: str, counts: str, latest: str, name: str, parts: Sequence[str]) -> None:
    """Counts of merged batches out of those of their parts, for the games that are still there."""
    games = tables.games_of_batch(spark, parsed, name)
    own = F.col("game_name").eqNullSafe(F.col("_game"))

    def of_parts(table: str) -> DataFrame:
        rows = spark.table(table).where(F.col("batch_id").isin(list(parts)))
        return rows.join(games, own, "left_semi").withColumn("batch_id", F.lit(name))

    newest = first_n(of_parts(latest), _BY, [F.desc("timestamp"), F.col("content_id")], KEPT)
    write_batches(stage(newest, "latest"), latest)
    sums = of_parts(counts).groupBy(*_BY, "kind", "category", "sub_category", "sentiment").agg(F.sum("count").alias("count"))
    write_batches(stage(sums, "counts"), counts)


def _midnight(bound: object) -> date:
    moment = bound if isinstance(bound, date) else datetime.fromisoformat(str(bound))
    if isinstance(moment, datetime):
        if (moment.hour, moment.minute, moment.second, moment.microsecond) != (0, 0, 0, 0):
            raise ValueError(f"counts are kept by day; {bound} is not a midnight")
        return moment.date()
    return moment


def _in_days(rows: DataFrame, request: reports.Request) -> DataFrame:
    """Rows of the closed range: all of its days, and of the last one its midnight only."""
    start, end = F.lit(_midnight(request.start)), F.lit(_midnight(request.end))
    chosen = rows.where((F.col("day") >= start) & ((F.col("day") < end) | ((F.col("day") == end) & F.col("at_midnight"))))
    return chosen if request.update_type == "REFRESH" else chosen.where(F.col("game_name") == request.game_name)


def build_reports_from_counts(counts: DataFrame, latest: DataFrame, request: reports.Request) -> DataFrame:
    """The reports that :func:`feedloom.plans.reports.build_reports_from_parsed` builds, out of counts by day."""
    if request.n_items > KEPT:
        raise ValueError(f"{KEPT} items of a day are kept, {request.n_items} cannot be listed")
    chosen = _in_days(counts, request)
    overall = chosen.where("kind = 'overall'").groupBy("game_name", F.col("sentiment").alias("overall_sentiment"))
    overall = overall.agg(F.sum("count").alias("number_of_items"))
    topics = chosen.where("kind = 'topic'").groupBy("game_name", "category", "sub_category", "sentiment")
    topics = topics.agg(F.sum("count").alias("count"))
    newest = reports.report_items(_in_days(latest, request), request.n_items)
    scope = reports.report_scope(counts, request.update_type, request.game_name)
    return reports.build_from_tables(scope, reports.tables_of(overall, topics, newest), request)


def write_reports_from_counts(spark: SparkSession, chain: Chain, request: reports.Request) -> None:
    """Bring the counts up to date, build reports out of them and save them."""
    update_counts(spark, chain)
    with scratch(spark):
        built = build_reports_from_counts(spark.table(chain.table(COUNTS)), spark.table(chain.table(LATEST)), request)
        tables.save_reports(built, chain.table(REPORTS), request.update_type)
