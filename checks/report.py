"""Markdown tables, context, prompts, answers and report rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import check, views
from checks.measure import _COUNTS, _RANGE, _RATED, END, NEWEST, START, TOP, chosen, rated
from checks.views import plain, sql
from feedloom.functions.prompts import PERSONAS
from feedloom.plans import reports
from feedloom.plans.staging import stage


def _line(*columns: str) -> str:
    cells = [
        f"replace(replace(replace(coalesce(CAST({c} AS VARCHAR), ''), chr(13), ' '), chr(10), ' '), "
        "'|', '\\|')"
        for c in columns
    ]
    return "'| ' || " + " || ' | ' || ".join(cells) + " || ' |'"


def _table(columns: str, rows: str, order: str) -> str:
    names = columns.split(", ")
    head = f"| {' | '.join(names)} |' || chr(10) || '|{' --- |' * len(names)}"
    return (
        f"SELECT game_name, '{head}' || chr(10) || string_agg({_line(*names)}, chr(10) "
        f"ORDER BY {order}) AS lines FROM ({rows}) GROUP BY game_name"
    )


def _head(columns: str) -> str:
    names = columns.split(", ")
    return f"'| {' | '.join(names)} |' || chr(10) || '|{' --- |' * len(names)}'"


# Words that are not known sentiments share one line.
_OVERALL = (
    "CASE WHEN items.overall_sentiment IS NULL OR items.overall_sentiment IN ('positive', 'negative', 'neutral') "
    f"THEN items.overall_sentiment ELSE '{reports.OTHER_VALUES}' END"
)


def tables_sql(where: str) -> str:
    """The five tables of every game with items in range."""
    total, overall = "total_items", "overall_sentiment, number_of_items"
    categories = (
        "category, number_of_positive_items, number_of_negative_items, number_of_neutral_items"
    )
    sub_categories, newest = "category, sub_category, sentiment, count", "content_type, translated_content_text"
    counted = f"FROM items WHERE {where} GROUP BY ALL"
    sums = ", ".join(
        f"count(*) FILTER (sentiment = '{s}') AS number_of_{s}_items"
        for s in ("positive", "negative", "neutral")
    )
    return (
        "SELECT t.game_name, t.lines AS total, o.lines AS overall, "
        f"coalesce(c.lines, {_head(categories)}) AS categories, "
        f"coalesce(s.lines, {_head(sub_categories)}) AS sub_categories, n.lines AS items "
        f"FROM ({_table(total, f'SELECT game_name, count(*) AS total_items {counted}', '1')}) t "
        "JOIN ("
        + _table(overall, f"SELECT game_name, {_OVERALL} AS overall_sentiment, count(*) AS number_of_items {counted}", "overall_sentiment")
        + ") o USING (game_name) LEFT JOIN ("
        + _table(categories, f"SELECT game_name, category, {sums} FROM ({_RATED}) GROUP BY ALL", "category")
        + ") c USING (game_name) LEFT JOIN ("
        + _table(sub_categories, TOP, "category, rank")
        + ") s USING (game_name) JOIN ("
        + _table(newest, NEWEST.format(where=f"WHERE {where}"), "timestamp DESC, content_id")
        + ") n USING (game_name)"
    )


def context_sql(scope: str = "SELECT DISTINCT game_name FROM items") -> str:
    empty = {
        "total": _head("total_items") + " || chr(10) || '| 0 |'",
        **{
            name: _head(", ".join(reports.TABLES[name]))
            for name in ("overall", "categories", "sub_categories", "items")
        },
    }
    blocks = " || chr(10) || chr(10) || ".join(
        f"'{reports.TITLES[name]}:' || chr(10) || coalesce({name}, {empty[name]})"
        for name in reports.TABLES
    )
    return f"SELECT g.game_name, {blocks} AS context FROM ({scope}) g LEFT JOIN ({tables_sql(_RANGE)}) b USING (game_name)"


_PERSONAS = ", ".join(
    "('{}', '{}', '{}')".format(p.name, p.label, p.template.replace("'", "''")) for p in PERSONAS
)


def prompts_sql(scope: str = "SELECT DISTINCT game_name FROM items") -> str:
    return (
        f"SELECT c.*, persona, label, replace(template, '{{context}}', context) AS prompt "
        f"FROM ({context_sql(scope)}) c, (VALUES {_PERSONAS}) p(persona, label, template)"
    )


def rows_sql(scope: str = "SELECT DISTINCT game_name FROM items") -> str:
    return (
        "SELECT game_name, persona, TIMESTAMP '2024-01-04 00:00:00' AS report_date, "
        "'### Player feedback report for the ' || label || chr(10) || chr(10) || "
        f"'{START} to {END}' || chr(10) || chr(10) || '## Summary' || chr(10) || chr(10) || context "
        f"AS report_contents, '{START}' AS start_date, '{END}' AS end_date FROM ({prompts_sql(scope)})"
    )


REQUEST = reports.Request(START, END, datetime(2024, 1, 4))


def _tables(spark, sf):
    return reports.markdown_tables(chosen(spark, sf), rated(spark, sf))


def _prompts(spark, sf):
    scope = reports.report_scope(views.items(spark, sf), "REFRESH")
    return reports.report_prompts(reports.report_context(scope, _tables(spark, sf)))


@check("markdown_tables", sql(tables_sql(_RANGE)))
def markdown_tables(spark, sf):
    return _tables(spark, sf)


@check("report_context", sql(context_sql()))
def report_context(spark, sf):
    scope = reports.report_scope(views.items(spark, sf), "REFRESH")
    return reports.report_context(scope, _tables(spark, sf))


@check(
    "report_scope",
    sql(
        "SELECT 'REFRESH' AS update_type, game_name FROM (SELECT DISTINCT game_name FROM items) "
        "UNION ALL SELECT 'NEW_GAME', 'src3'"
    ),
)
def report_scope(spark, sf):
    items = views.items(spark, sf)
    every, one = (
        reports.report_scope(items, kind, "src3").select(F.lit(kind).alias("update_type"), "game_name")
        for kind in ("REFRESH", "NEW_GAME")
    )
    return every.unionByName(one)


@check("report_prompts", sql(prompts_sql()))
def report_prompts(spark, sf):
    return _prompts(spark, sf)


@check(
    "report_answers",
    sql(
        "SELECT game_name, persona, '## Summary' || chr(10) || chr(10) || context AS answer, "
        f"md5(replace(prompt, 'e', '3')) AS model_answer FROM ({prompts_sql()})"
    ),
)
def report_answers(spark, sf):
    prompts = stage(_prompts(spark, sf), "prompts")
    own = reports.answer_prompts(prompts)
    model = lambda: lambda prompts: [p.replace("e", "3") for p in prompts]
    asked = reports.answer_prompts(prompts, model)
    asked = asked.select("game_name", "persona", F.md5("answer").alias("model_answer"))
    return own.select("game_name", "persona", "answer").join(asked, ["game_name", "persona"])


@check("report_rows", sql(rows_sql()))
def report_rows(spark, sf):
    items, topics = views.items(spark, sf), views.topics(spark, sf)
    return plain(reports.build_reports(items, topics, REQUEST))


@check("report_rows_from_parsed", sql(rows_sql()))
def report_rows_from_parsed(spark, sf):
    return plain(reports.build_reports_from_parsed(views.parsed(spark, sf), REQUEST))
