"""Tables: create, merge, replace, count and delete."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import check, views
from checks.views import plain, sql
from feedloom import schemas
from feedloom.operators import merge, tables
from feedloom.plans import reports
from feedloom.plans.staging import fresh_path
from feedloom.streaming.upsert import upsert

_BATCH = "content_id, content_type, game_name, content_text, timestamp, author_id, content_metadata"
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY timestamp DESC) = 1"
MERGED = (
    f"SELECT {_BATCH} FROM first_delivery UNION ALL (SELECT {_BATCH} FROM second_delivery "
    f"WHERE content_id NOT IN (SELECT content_id FROM first_delivery) {_NEWEST})"
)


def database(spark, name):
    """A database of its own in the shared folder."""
    own = f"{name}_{uuid4().hex}"
    tables.use_database(spark, own, fresh_path(spark, own))
    return own


def feedback_rows(spark, table):
    return plain(tables.items_of(spark, table)).select(*_BATCH.split(", "))


@check("sink_create", sql(f"SELECT {_BATCH} FROM feedback"))
def sink_create(spark, sf):
    table = f"{database(spark, 'created')}.bronze"
    upsert(views.feedback(spark, sf), table)
    tables.create_item_table(spark, table, schemas.FEEDBACK)
    return feedback_rows(spark, table)


@check("merge_insert_only", sql(MERGED))
def merge_insert_only(spark, sf):
    table = f"{database(spark, 'merged')}.bronze"
    upsert(views.first_delivery(spark, sf), table)
    upsert(views.second_delivery(spark, sf), table)
    upsert(views.second_delivery(spark, sf), table)
    return feedback_rows(spark, table)


@check(
    "merge_null_keys",
    sql(
        "SELECT CASE WHEN event_type = 'error' THEN 'made' ELSE content_id END AS content_id, "
        "game_name, content_text, timestamp, author_id FROM feedback"
    ),
)
def merge_null_keys(spark, sf):
    """Rows without an id are kept apart, and merging them again adds nothing."""
    table = f"{database(spark, 'keyless')}.bronze"
    is_error = F.get_json_object("content_metadata", "$.event_type") == "error"
    rows = views.feedback(spark, sf).withColumn("content_id", F.when(~is_error, F.col("content_id")))
    for _ in range(2):
        upsert(rows.unionByName(rows), table)
    made = F.when(F.col("content_id").startswith("row-"), "made").otherwise(F.col("content_id"))
    kept = feedback_rows(spark, table).withColumn("content_id", made)
    return kept.drop("content_type", "content_metadata")


@check("dedup_batch", sql(f"SELECT {_BATCH} FROM second_delivery {_NEWEST}"))
def dedup_batch(spark, sf):
    return plain(merge.newest_copy(views.second_delivery(spark, sf)))


@check(
    "sink_report_modes",
    sql(
        "SELECT game_name, persona, '2024-01-01' AS start_date, n FROM (SELECT DISTINCT game_name "
        "FROM items) g, (VALUES ('community_manager'), ('marketer'), ('game_designer')) p(persona), "
        "(VALUES (1), (2)) n(n) WHERE n = 1 OR game_name = 'src3'"
    ),
)
def sink_report_modes(spark, sf):
    table = f"{database(spark, 'reports')}.reports"
    parsed = views.parsed(spark, sf)
    every = reports.Request("2024-01-01", "2024-01-03", datetime(2024, 1, 4))
    one = replace(every, update_type="NEW_GAME", game_name="src3")
    for request in (every, every, one):
        built = reports.build_reports_from_parsed(parsed, request)
        tables.save_reports(built, table, request.update_type)
    copy = Window.partitionBy("game_name", "persona").orderBy("report_contents")
    saved = spark.table(table).withColumn("n", F.row_number().over(copy))
    return saved.select("game_name", "persona", "start_date", "n")


def _three_tables(spark, sf, name):
    own = database(spark, name)
    upsert(views.feedback(spark, sf), f"{own}.bronze")
    tables.create_item_table(spark, f"{own}.topics", schemas.TOPICS)
    tables.write_batch(views.topics(spark, sf), f"{own}.topics", "all")
    per_game = views.items(spark, sf).groupBy("game_name").agg(F.count("*").alias("n"))
    per_game.write.format("parquet").saveAsTable(f"{own}.totals")
    return tables.tables_with_games(spark, own)


_COUNTS = (
    "SELECT 'bronze' AS table_name, {0} AS row_count FROM feedback UNION ALL "
    "SELECT 'topics', {0} FROM topics UNION ALL "
    "SELECT 'totals', {0} FROM (SELECT DISTINCT game_name FROM items)"
)


@check("audit_counts_by_game", sql(_COUNTS.format("count(*) FILTER (game_name = 'src3')")))
def audit_counts_by_game(spark, sf):
    return tables.audit_counts(spark, _three_tables(spark, sf, "audited"), "src3")


@check(
    "delete_by_game",
    sql(
        "SELECT 'bronze' AS table_name, game_name, content_id, NULL AS category FROM feedback "
        "WHERE game_name <> 'src3' UNION ALL "
        "SELECT 'topics', game_name, content_id, category FROM topics WHERE game_name <> 'src3' UNION ALL "
        "SELECT DISTINCT 'totals', game_name, NULL, NULL FROM items WHERE game_name <> 'src3'"
    ),
)
def delete_by_game(spark, sf):
    names = _three_tables(spark, sf, "deleted")
    tables.delete_game(spark, names, "src3")
    rows = None
    for name in names:
        short = name.split(".")[-1].strip("`")
        own = spark.table(name)
        columns = [
            F.col(c) if c in own.columns else F.lit(None).cast("string").alias(c)
            for c in ("content_id", "category")
        ]
        part = own.select(F.lit(short).alias("table_name"), "game_name", *columns)
        rows = part if rows is None else rows.unionByName(part)
    return rows
