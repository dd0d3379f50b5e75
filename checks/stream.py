"""Streams: incremental reads, appends, deletes upstream, second runs, upserts."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import functions as F

from checks import check, views
from checks.table import MERGED, database, feedback_rows
from checks.views import plain, sql
from feedloom import schemas
from feedloom.functions.prompts import extraction_prompt
from feedloom.operators import merge, tables, unify
from feedloom.operators.inference import extract, translate
from feedloom.plans.staging import fresh_path
from feedloom.sources import landed as files
from feedloom.streaming import chain as streams
from feedloom.streaming.upsert import upsert, upsert_stream


def chain_on(spark, name, **options):
    """A chain whose model answers are those of the views."""
    chosen = {"translate": views.translate_none, "extract": views.answer, **options}
    checkpoints = fresh_path(spark, f"{name}-checkpoints")
    return streams.Chain(database(spark, name), checkpoints=checkpoints, **chosen)


def _topics(spark, chain):
    return tables.items_of(spark, chain.table(streams.TOPICS))


@check("stream_incremental_scan", sql(MERGED))
def stream_incremental_scan(spark, sf):
    """Two runs of a stream that copies bronze, rows added in between."""
    own = database(spark, "scanned")
    copy = partial(
        streams.append_table,
        table=f"{own}.copy",
        ddl=schemas.FEEDBACK,
        transform=lambda rows: rows,
        checkpoint=fresh_path(spark, "scanned-checkpoint"),
    )
    for delivery in (views.first_delivery, views.second_delivery):
        upsert(delivery(spark, sf), f"{own}.bronze")
        copy(streams.new_rows(spark, f"{own}.bronze", schemas.FEEDBACK)).awaitTermination()
    return feedback_rows(spark, f"{own}.copy")


@check(
    "stream_append_table",
    sql(
        "SELECT 's' || doc_id AS content_id, source AS game_name, text AS content_text, "
        "date_trunc('second', ts) AS timestamp FROM docs"
    ),
)
def stream_append_table(spark, sf):
    """Landed reviews, a few files at a time, into an append-only table."""
    own = database(spark, "appended")
    written = fresh_path(spark, "appended-source")
    files.read_steam(spark, views.landed(spark, sf)["steam"]).repartition(6).write.parquet(written)
    source = spark.readStream.schema(spark.read.parquet(written).schema)
    landed = source.option("maxFilesPerTrigger", 2).parquet(written)
    rows = unify.unify_steam(unify.name_games(landed))
    checkpoint = fresh_path(spark, "appended-checkpoint")
    reviews = f"{own}.reviews"
    stream = streams.append_table(rows, reviews, schemas.FEEDBACK, lambda new: new, checkpoint)
    stream.awaitTermination()
    kept = tables.items_of(spark, reviews)
    return plain(kept.select("content_id", "game_name", "content_text", "timestamp"))


@check("stream_chain", sql("SELECT * FROM topics"))
def stream_chain(spark, sf):
    """Bronze through all five tables."""
    chain = chain_on(spark, "chained")
    upsert(views.feedback(spark, sf), chain.table(streams.BRONZE))
    streams.refresh(spark, chain)
    return _topics(spark, chain)


_ALL = (
    "SELECT * FROM topics WHERE content_id IN (SELECT content_id FROM first_delivery) UNION ALL "
    "SELECT * FROM topics WHERE content_id IN (SELECT content_id FROM second_delivery)"
    " AND content_id NOT IN (SELECT content_id FROM first_delivery)"
)


@check("stream_second_run", sql(_ALL))
def stream_second_run(spark, sf):
    """Two deliveries, and a third run that finds nothing new."""
    chain = chain_on(spark, "rerun")
    for delivery in (views.first_delivery, views.second_delivery):
        upsert(delivery(spark, sf), chain.table(streams.BRONZE))
        streams.refresh(spark, chain)
    streams.refresh(spark, chain)
    return _topics(spark, chain)


def not_delivered_first(spark, sf):
    """Feedback without the first delivery; ids meet, not texts."""
    return merge.not_yet_in(views.feedback(spark, sf), views.first_delivery(spark, sf))


@check(
    "stream_after_delete",
    sql(
        "SELECT 'topics' AS table_name, content_id, game_name, category FROM topics UNION ALL "
        "SELECT 'bronze', content_id, game_name, NULL FROM feedback WHERE game_name <> 'src3' "
        "OR content_id NOT IN (SELECT content_id FROM first_delivery)"
    ),
)
def stream_after_delete(spark, sf):
    """A game is deleted from bronze between two runs: what is downstream stays,
    and its later items still arrive."""
    chain = chain_on(spark, "cleaned")
    bronze = chain.table(streams.BRONZE)
    upsert(views.first_delivery(spark, sf), bronze)
    streams.refresh(spark, chain)
    upsert(views.feedback(spark, sf), bronze)
    streams.refresh(spark, chain)
    tables.delete_game(spark, [bronze], "src3")
    streams.refresh(spark, chain)
    upsert(not_delivered_first(spark, sf), bronze)
    streams.refresh(spark, chain)
    topics = _topics(spark, chain).select(
        F.lit("topics").alias("table_name"), "content_id", "game_name", "category"
    )
    left = tables.items_of(spark, bronze).select(
        F.lit("bronze").alias("table_name"),
        "content_id",
        "game_name",
        F.lit(None).cast("string").alias("category"),
    )
    return topics.unionByName(left)


@check("stream_upsert", sql(MERGED))
def stream_upsert(spark, sf):
    """Two streams into one table, the second with rows the first brought."""
    own = database(spark, "upserted")
    for number, delivery in enumerate((views.first_delivery, views.second_delivery)):
        path = fresh_path(spark, "delivery")
        delivery(spark, sf).write.parquet(path)
        rows = spark.readStream.schema(schemas.FEEDBACK).parquet(path)
        for _ in range(2):
            checkpoint = f"{fresh_path(spark, 'upsert')}-{number}"
            upsert_stream(rows, f"{own}.bronze", checkpoint)
    return feedback_rows(spark, f"{own}.bronze")


@check(
    "stream_composite_key",
    sql(
        "SELECT 'items' AS table_name, content_id, kind AS content_type, game_name, NULL AS category "
        "FROM items, (VALUES ('Steam Review'), ('Google Play Review')) k(kind) UNION ALL "
        "SELECT 'topics', content_id, kind, game_name, category "
        "FROM topics, (VALUES ('Steam Review'), ('Google Play Review')) k(kind)"
    ),
)
def stream_composite_key(spark, sf):
    """One id on two stores is two items, in every table, also when they come one after the other."""
    chain = chain_on(spark, "two_stores", keys=("content_type", "content_id"))
    for kind in ("Steam Review", "Google Play Review", "Steam Review"):
        rows = views.feedback(spark, sf).withColumn("content_type", F.lit(kind))
        upsert(rows, chain.table(streams.BRONZE), chain.keys)
        streams.refresh(spark, chain)
    items = tables.items_of(spark, chain.table(streams.ITEMS)).select(
        F.lit("items").alias("table_name"), "content_id", "content_type", "game_name",
        F.lit(None).cast("string").alias("category"),
    )
    topics = _topics(spark, chain).select(
        F.lit("topics").alias("table_name"), "content_id", "content_type", "game_name", "category"
    )
    return items.unionByName(topics)


@check(
    "stream_quality",
    sql(
        "SELECT 1 AS run, count(*) AS row_count, count(*) FILTER (overall IS NULL) AS broken "
        "FROM parsed_all UNION ALL "
        "SELECT 2, count(*), count(*) FROM parsed_all WHERE overall IS NULL"
    ),
)
def stream_quality(spark, sf):
    """Rows and violations of a run, and of one with new checkpoints: broken rows, which no
    table holds, are parsed and dropped again, all others are known."""
    found = []
    chain = chain_on(spark, "counted", on_quality=lambda counts: found.append((run, dict(counts))))
    upsert(views.feedback(spark, sf), chain.table(streams.BRONZE))
    for run in (1, 2):
        streams.refresh(spark, replace(chain, checkpoints=fresh_path(spark, "counted-checkpoints")))
    counted = [(n, c["rows"], c["valid_overall_sentiment"]) for n, c in found]
    rows = spark.createDataFrame(counted, "run int, row_count long, broken long")
    return rows.groupBy("run").agg(F.sum("row_count").alias("row_count"), F.sum("broken").alias("broken"))


@check(
    "quarantine_rows",
    sql(
        "SELECT 'kept' AS table_name, content_id, game_name, '' AS broken FROM parsed_all "
        "WHERE overall IS NOT NULL AND content_type <> 'Reddit Comment' UNION ALL "
        "SELECT 'broken', content_id, game_name, concat_ws(', ', CASE WHEN overall IS NULL THEN 'rated' END, "
        "CASE WHEN content_type = 'Reddit Comment' THEN 'review' END) FROM parsed_all "
        "WHERE overall IS NULL OR content_type = 'Reddit Comment'"
    ),
)
def quarantine_rows(spark, sf):
    """Rows that break rules, with the names of these, beside the rows that are kept; two deliveries, the second
    read by new streams, so that all broken rows are met twice."""
    rules = {"rated": "overall IS NOT NULL", "review": "content_type <> 'Reddit Comment'"}
    chain = chain_on(spark, "quarantined", rules=rules, quarantine=True)
    for delivery in (views.first_delivery(spark, sf), views.feedback(spark, sf)):
        upsert(delivery, chain.table(streams.BRONZE))
        streams.refresh(spark, replace(chain, checkpoints=fresh_path(spark, "quarantined-checkpoints")))
    kept = tables.items_of(spark, chain.table(streams.PARSED)).withColumn("broken", F.lit(""))
    rest = tables.items_of(spark, chain.table(streams.QUARANTINE)).withColumn("broken", F.array_join("broken", ", "))
    names = ["content_id", "game_name", "broken"]
    kept, rest = (df.select(F.lit(name).alias("table_name"), *names) for df, name in ((kept, "kept"), (rest, "broken")))
    return kept.unionByName(rest)


def _translator():
    return lambda texts: [f"[{text[:20]}]" for text in texts]


def _extractor():
    """Answers by a hash of what follows the directions, so that SQL can say the same."""
    from hashlib import md5

    def answer(prompts):
        mood = {"0": "positive", "1": "negative"}
        digits = [md5(prompt[length:].encode()).hexdigest()[0] for prompt in prompts]
        return [f'{{"overall":"{mood.get(d, "neutral")}","summary":"{d}"}}' for d in digits]

    length = len(extraction_prompt())
    return answer


@check(
    "stream_chain_models",
    sql(
        "SELECT content_id, '[' || substr(content_text, 1, 20) || ']' AS translated_content_text, "
        "CASE substr(md5(content_text), 1, 1) WHEN '0' THEN 'positive' WHEN '1' THEN 'negative' "
        "ELSE 'neutral' END AS overall_sentiment, substr(md5(content_text), 1, 1) AS ai_summary FROM feedback"
    ),
)
def stream_chain_models(spark, sf):
    """Both model steps run as models on the executors, inside the streams."""
    chain = chain_on(
        spark,
        "modelled",
        translate=partial(translate, load_model=_translator),
        extract=partial(extract, load_model=_extractor),
    )
    upsert(views.feedback(spark, sf), chain.table(streams.BRONZE))
    streams.refresh(spark, chain)
    items = tables.items_of(spark, chain.table(streams.ITEMS))
    return items.select("content_id", "translated_content_text", "overall_sentiment", "ai_summary")
