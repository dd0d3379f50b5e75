"""Reports per game and audience, built for all games in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import markdown
from feedloom.functions.prompts import PERSONAS, Persona
from feedloom.operators import metrics
from feedloom.operators.extraction import gold_items, gold_topics
from feedloom.operators.inference import Model, infer
from feedloom.plans.ranking import first_n
from feedloom.plans.staging import stage
from feedloom.schemas import CATEGORIES, SENTIMENTS

# Column heads of the five tables, in the order they appear in a report.
TABLES = {
    "total": ("total_items",),
    "overall": ("overall_sentiment", "number_of_items"),
    "categories": (
        "category",
        "number_of_positive_items",
        "number_of_negative_items",
        "number_of_neutral_items",
    ),
    "sub_categories": ("category", "sub_category", "sentiment", "count"),
    "items": ("content_type", "translated_content_text"),
}
# The line of all sentiment words that are not known ones.
OTHER_VALUES = "other values"
TITLES = {
    "total": "Feedback items",
    "overall": "Overall sentiment",
    "categories": "Sentiment by category",
    "sub_categories": "Most frequent sub-categories",
    "items": "Latest items",
}


def report_items(items: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest items of every game; each task sends at most ``n`` per game."""
    return first_n(items, ["game_name"], [F.desc("timestamp"), F.col("content_id")], n)


def report_scope(items: DataFrame, update_type: str, game_name: str | None = None) -> DataFrame:
    """Games to report on: all on a refresh, else the one named."""
    if update_type == "REFRESH":
        return metrics.distinct_games(items)
    return items.sparkSession.createDataFrame([(game_name,)], "game_name string")


def markdown_tables(items: DataFrame, rated: DataFrame, n_items: int = 10) -> DataFrame:
    """Five markdown tables per game that has items, one column each.

    ``rated`` holds the topic rows of ``items``. Items and topics are each
    counted once, and the lines of all tables come together in one grouping by
    game. A game adds only its aggregates to it, never its items, and a bounded number of
    them: one line per known sentiment and one for all other words, one line per category.
    """
    return tables_of(metrics.overall_sentiment(items), metrics.subcategory_counts(rated), report_items(items, n_items))


def tables_of(overall: DataFrame, counts: DataFrame, newest: DataFrame) -> DataFrame:
    """The same tables out of items counted by sentiment, topics counted, and the items to list."""
    overall = _few_values(overall)
    total = overall.groupBy("game_name").agg(F.sum("number_of_items").alias("total_items"))
    newest_first = -F.unix_micros("timestamp")

    lines = _lines(total, "total")
    for more in (
        _lines(overall, "overall", second=F.col("overall_sentiment")),
        _lines(_category_sums(counts), "categories", second=F.col("category")),
        _lines(
            metrics.top_subcategories(counts),
            "sub_categories",
            second=F.col("category"),
            third=F.col("rank"),
        ),
        _lines(newest, "items", first=newest_first, second=F.col("content_id")),
    ):
        lines = lines.unionByName(more)

    own = {name: F.when(F.col("table") == name, F.struct("place", "line")) for name in TABLES}
    stacked = lines.groupBy("game_name").agg(
        *[F.array_sort(F.collect_list(line)).alias(name) for name, line in own.items()]
    )
    tables = {name: markdown.table(TABLES[name], F.col(name)["line"]) for name in TABLES}
    return stacked.select("game_name", *[table.alias(name) for name, table in tables.items()])


def _lines(
    rows: DataFrame,
    table: str,
    *,
    first: Column | None = None,
    second: Column | None = None,
    third: Column | None = None,
) -> DataFrame:
    """Rows as lines of one table; the three columns give their order in it."""
    place = F.struct(
        (F.lit(0) if first is None else first).cast("long").alias("first"),
        (F.lit("") if second is None else second).alias("second"),
        (F.lit(0) if third is None else third).cast("long").alias("third"),
    )
    cells = [F.col(name) for name in TABLES[table]]
    return rows.select(
        "game_name",
        F.lit(table).alias("table"),
        place.alias("place"),
        markdown.line(*cells).alias("line"),
    )


def _few_values(overall: DataFrame) -> DataFrame:
    """Counts of the known sentiments and of no answer; all other words together."""
    word = F.col("overall_sentiment")
    known = word.isNull() | word.isin(*SENTIMENTS)
    named = overall.withColumn("overall_sentiment", F.when(known, word).otherwise(OTHER_VALUES))
    return named.groupBy("game_name", "overall_sentiment").agg(
        F.sum("number_of_items").alias("number_of_items")
    )


def _category_sums(counts: DataFrame) -> DataFrame:
    """The category pivot out of finer counts, so that topics are joined once."""
    return counts.groupBy("game_name", "category").agg(
        *[
            F.sum(F.when(F.col("sentiment") == value, F.col("count")).otherwise(0)).alias(
                f"number_of_{value}_items"
            )
            for value in ("positive", "negative", "neutral")
        ]
    )


def report_context(scope: DataFrame, tables: DataFrame) -> DataFrame:
    """The titled tables of every game in scope, as one text.

    A game without items gets a total of zero and empty tables.
    """
    empty = {name: F.lit(markdown.head(heads)) for name, heads in TABLES.items()}
    empty["total"] = F.concat(empty["total"], F.lit("\n"), markdown.line(F.lit(0)))
    blocks = [
        F.concat(F.lit(f"{TITLES[name]}:\n"), F.coalesce(name, empty[name])) for name in TABLES
    ]
    joined = scope.join(tables, "game_name", "left")
    return joined.select("game_name", F.concat_ws("\n\n", *blocks).alias("context"))


def for_personas(games: DataFrame, personas: Sequence[Persona] = PERSONAS) -> DataFrame:
    """Every row once per persona, with the persona's label and template."""
    known = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("persona"),
                F.lit(p.label).alias("label"),
                F.lit(p.template).alias("template"),
            )
            for p in personas
        ]
    )
    return games.select("*", F.inline(known))


def report_prompts(context: DataFrame, personas: Sequence[Persona] = PERSONAS) -> DataFrame:
    prompt = F.replace("template", F.lit("{context}"), "context")
    return for_personas(context, personas).withColumn("prompt", prompt).drop("template")


def answer_prompts(prompts: DataFrame, load_model: Callable[[], Model] | None = None) -> DataFrame:
    """Add ``answer``; without a model it is the figures under a heading."""
    if load_model is None:
        return prompts.withColumn("answer", F.concat(F.lit("## Summary\n\n"), "context"))
    # Few rows, but every action on them builds the report tables again.
    written = stage(prompts, "prompts")
    return infer(written, F.col("prompt"), "answer", load_model, id_col="game_name")


def report_rows(answers: DataFrame, start: str, end: str, run_time: datetime) -> DataFrame:
    """One report per game and persona: a header, then the answer."""
    header = F.format_string(
        f"### Player feedback report for the %s\n\n{start} to {end}\n\n", "label"
    )
    return answers.select(
        "game_name",
        "persona",
        F.lit(run_time).cast("timestamp").alias("report_date"),
        F.concat(header, "answer").alias("report_contents"),
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
    )


@dataclass(frozen=True)
class Request:
    """What to report on: all games on a refresh, else one, and for which days."""

    start: str
    end: str
    run_time: datetime
    update_type: str = "REFRESH"
    game_name: str | None = None
    personas: Sequence[Persona] = PERSONAS
    n_items: int = 10
    load_model: Callable[[], Model] | None = None

    def choose(self, rows: DataFrame) -> DataFrame:
        game = None if self.update_type == "REFRESH" else self.game_name
        return metrics.in_range(rows, self.start, self.end, game)


def build_reports(items: DataFrame, topics: DataFrame, request: Request) -> DataFrame:
    """Report rows out of the two gold tables, which are joined for the time of a topic."""
    chosen = request.choose(items)
    return _build(items, chosen, metrics.topics_of_items(topics, chosen), request)


def build_reports_from_parsed(
    parsed: DataFrame, request: Request, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """The same reports out of the parsed table, which both gold tables come from.

    A parsed row holds the item and its topics together, so nothing is joined:
    topics are counted where they are read, and only counts are shuffled.
    """
    chosen = request.choose(parsed)
    rated = gold_topics(chosen, categories)
    return _build(parsed, gold_items(chosen), rated, request)


def _build(every: DataFrame, items: DataFrame, rated: DataFrame, request: Request) -> DataFrame:
    tables = markdown_tables(items, rated, request.n_items)
    scope = report_scope(every, request.update_type, request.game_name)
    return build_from_tables(scope, tables, request)


def build_from_tables(scope: DataFrame, tables: DataFrame, request: Request) -> DataFrame:
    """Report rows of the games in scope out of their five tables."""
    prompts = report_prompts(report_context(scope, tables), request.personas)
    answers = answer_prompts(prompts, request.load_model)
    return report_rows(answers, request.start, request.end, request.run_time)
