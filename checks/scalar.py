"""Each scalar function once, over all feedback."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check, views
from checks.views import plain, sql
from feedloom.functions.prompts import PERSONAS


@check(
    "scalar_bundle",
    sql(
        "SELECT content_id, 'Text: ' || content_text AS prompt, "
        "CAST(floor(epoch(timestamp)) AS BIGINT) AS seconds, "
        "date_trunc('second', timestamp) AS from_epoch, CAST(timestamp AS DATE) AS day, "
        "strftime(timestamp, '%Y-%m-%d') AS day_text, "
        "datediff('day', CAST(timestamp AS DATE), DATE '2024-02-01') AS days_left, "
        "CAST(author_id AS BIGINT) AS author_number, coalesce(NULLIF(lang, 'de'), '') AS language, "
        "contains(lower(content_text), 'the') AS says_the, "
        "replace('<{context}>', '{context}', game_name) AS filled, "
        "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error, "
        "CASE event_type WHEN 'view' THEN 'Marketer' WHEN 'click' THEN 'Game Designer' "
        "ELSE 'Community Manager' END AS label FROM feedback"
    ),
)
def scalar_bundle(spark, sf):
    meta = F.from_json("content_metadata", "map<string,string>")
    persona = F.create_map(F.lit("view"), F.lit("marketer"), F.lit("click"), F.lit("game_designer"))
    labels = {p.name: p.label for p in PERSONAS}
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    rows = views.feedback(spark, sf).withColumn("meta", meta)
    event = F.col("meta")["event_type"]
    seconds = F.unix_seconds("timestamp")
    return plain(
        rows.select(
            "content_id",
            F.concat(F.lit("Text: "), "content_text").alias("prompt"),
            seconds.alias("seconds"),
            F.timestamp_seconds(seconds).alias("from_epoch"),
            F.to_date(F.timestamp_seconds(seconds)).alias("day"),
            F.date_format("timestamp", "yyyy-MM-dd").alias("day_text"),
            F.datediff(F.lit("2024-02-01").cast("date"), F.to_date("timestamp"))
            .cast("long")
            .alias("days_left"),
            F.col("author_id").cast("long").alias("author_number"),
            F.coalesce(F.nullif(F.col("meta")["language"], F.lit("de")), F.lit("")).alias("language"),
            F.lower("content_text").contains("the").alias("says_the"),
            F.replace(F.lit("<{context}>"), F.lit("{context}"), "game_name").alias("filled"),
            F.when(event == "error", 1).otherwise(0).alias("is_error"),
            F.coalesce(
                F.try_element_at(label, F.try_element_at(persona, event)),
                F.lit("Community Manager"),
            ).alias("label"),
        )
    )
