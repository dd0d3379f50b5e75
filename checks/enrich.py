"""Parsing, quality rule, gold tables and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check, views
from checks.views import LEXICON, plain, sql
from feedloom.functions.offline import GLOSSARY, glossary_translate, lexicon_extract
from feedloom.functions.prompts import extraction_prompt
from feedloom.operators import extraction, inference, quality
from feedloom.plans.staging import fresh_path
from feedloom.schemas import CATEGORIES

_OTHER_SQL = (
    "CASE WHEN other IS NOT NULL AND json_type(a, '$.other') = 'ARRAY' THEN "
    "array_to_string(list_transform(other, lambda o: coalesce(json_extract_string(o, '$.topic'), '') "
    "|| '=' || coalesce(json_extract_string(o, '$.sentiment'), '')), ';') END AS other"
)


def _other_text(df):
    """The list of other topics as text, so that both engines can be compared."""
    entry = lambda o: F.concat(
        F.coalesce(o["topic"], F.lit("")), F.lit("="), F.coalesce(o["sentiment"], F.lit(""))
    )
    return df.withColumn("other", F.array_join(F.transform("other", entry), ";"))


@check(
    "parse_extraction",
    sql(
        "SELECT content_id, json_extract_string(a, '$.overall') AS overall, "
        "json_extract_string(a, '$.summary') AS summary, "
        + ", ".join(
            f"json_extract_string(a, '$.{c}.sentiment') || '/' || "
            f"json_extract_string(a, '$.{c}.sub_topic') AS {c}"
            for c in CATEGORIES
        )
        + f", {_OTHER_SQL} FROM (SELECT *, json_extract(a, '$.other[*]') AS other FROM (SELECT "
        "content_id, CASE WHEN json_valid(content_topic) THEN content_topic::JSON END AS a "
        "FROM raw_extraction))"
    ),
)
def parse_extraction(spark, sf):
    found = extraction.parse_extraction(views.raw_extraction(spark, sf))
    per_category = [
        F.concat(F.col("answer")[c]["sentiment"], F.lit("/"), F.col("answer")[c]["sub_topic"]).alias(c)
        for c in CATEGORIES
    ]
    columns = ["content_id", "answer.overall", "answer.summary", *per_category, "answer.other"]
    return _other_text(found.select(*columns))


@check(
    "parsed_wide",
    sql(
        f"SELECT p.* EXCLUDE (other), {_OTHER_SQL} FROM parsed_all p JOIN (SELECT content_id, "
        "CASE WHEN json_valid(content_topic) THEN content_topic::JSON END AS a "
        "FROM raw_extraction) USING (content_id)"
    ),
)
def parsed_wide(spark, sf):
    return plain(_other_text(extraction.parsed_wide(views.raw_extraction(spark, sf))))


@check("expect_or_drop", sql("SELECT content_id, overall, summary FROM parsed"))
def expect_or_drop(spark, sf):
    wide = extraction.parsed_wide(views.raw_extraction(spark, sf))
    return quality.expect_or_drop(wide).select("content_id", "overall", "summary")


@check(
    "expect_metrics",
    sql(
        "SELECT 'valid_overall_sentiment' AS rule, count(overall) AS passed, "
        "count(*) - count(overall) AS dropped FROM parsed_all"
    ),
)
def expect_metrics(spark, sf):
    return quality.expect_metrics(extraction.parsed_wide(views.raw_extraction(spark, sf)))


@check("gold_items", sql("SELECT * FROM items"))
def gold_items(spark, sf):
    return plain(views.items(spark, sf))


@check("topics_unpivot", sql("SELECT * FROM category_topics"))
def topics_unpivot(spark, sf):
    return extraction.category_topics(views.parsed(spark, sf))


@check("topics_other", sql("SELECT * FROM other_topics"))
def topics_other(spark, sf):
    return extraction.other_topics(views.parsed(spark, sf))


@check("gold_topics", sql("SELECT * FROM topics"))
def gold_topics(spark, sf):
    return views.topics(spark, sf)


@check("union_topics", sql("SELECT * FROM category_topics UNION ALL SELECT * FROM other_topics"))
def union_topics(spark, sf):
    parsed = views.parsed(spark, sf)
    return extraction.union_topics(
        extraction.category_topics(parsed), extraction.other_topics(parsed)
    )


@check(
    "unpack_metadata",
    sql("SELECT content_id, event_type, lang AS language, "
        "CAST(json_extract_string(content_metadata, '$.n_chars') AS BIGINT) AS n_chars, "
        "CAST(json_extract_string(content_metadata, '$.k') AS BIGINT) AS k FROM feedback"),
)
def unpack_metadata(spark, sf):
    fields = {"event_type": "string", "language": "string", "n_chars": "bigint", "k": "bigint"}
    return extraction.unpack_metadata(views.feedback(spark, sf), fields)


def _translated_sql() -> str:
    pairs = {f"{code}:{word}": english for code, book in GLOSSARY.items() for word, english in book.items()}
    book = ", ".join(f"'{word}': '{english}'" for word, english in pairs.items())
    stem = "rtrim(w, '.,!?;:')"
    word = (
        f"coalesce(map_extract(MAP {{{book}}}, lang || ':' || lower({stem}))[1] || "
        f"substr(w, length({stem}) + 1), w)"
    )
    line = f"array_to_string(list_transform(string_split(l, ' '), lambda w: {word}), ' ')"
    return f"array_to_string(list_transform(string_split(content_text, chr(10)), lambda l: {line}), chr(10))"


@check(
    "ai_translate_column",
    sql(f"SELECT content_id, content_text, {_translated_sql()} AS translated_content_text FROM feedback"),
)
def ai_translate_column(spark, sf):
    language = F.get_json_object("content_metadata", "$.language")
    translated = glossary_translate(views.feedback(spark, sf), language=language)
    return translated.select("content_id", "content_text", "translated_content_text")


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def extracted_sql(rows: str) -> str:
    """What the lexicon finds in ``rows``: overall, subjects, words per category, other."""
    hit = "list_filter({0}, lambda x: list_contains(words, x))"
    praise, blame = (f"len({hit.format(_list(w))})" for w in (LEXICON.positive, LEXICON.negative))
    per_category = ", ".join(
        f"{hit.format(_list(LEXICON.categories[c]))}[1] AS {c}" for c in CATEGORIES
    )
    subjects = f"concat_ws(', ', {', '.join(CATEGORIES)})"
    return (
        f"SELECT *, overall || CASE WHEN {subjects} <> '' THEN ': ' || {subjects} ELSE '' END "
        f"AS summary FROM (SELECT *, CASE WHEN trim(content_text) = '' THEN NULL "
        f"WHEN {praise} > {blame} THEN 'positive' WHEN {blame} > {praise} THEN 'negative' "
        f"ELSE 'neutral' END AS overall, {per_category}, {hit.format(_list(LEXICON.other))} AS other "
        "FROM (SELECT *, string_split_regex(lower(content_text), '[^a-z0-9]+') AS words "
        f"FROM {rows}))"
    )


@check(
    "ai_extract_column",
    sql(
        "SELECT content_id, overall, summary, "
        + ", ".join(f"overall || '/' || {c} AS {c}" for c in CATEGORIES)
        + ", array_to_string(list_transform(other, lambda o: o || '=' || overall), ';') AS other "
        f"FROM ({extracted_sql('feedback')})"
    ),
)
def ai_extract_column(spark, sf):
    answered = lexicon_extract(views.feedback(spark, sf), lexicon=LEXICON)
    found = extraction.parse_extraction(answered)
    per_category = [
        F.concat(F.col("answer")[c]["sentiment"], F.lit("/"), F.col("answer")[c]["sub_topic"]).alias(c)
        for c in CATEGORIES
    ]
    columns = ["content_id", "answer.overall", "answer.summary", *per_category, "answer.other"]
    return _other_text(found.select(*columns))


@check(
    "ai_batch_model",
    sql("SELECT content_id, md5(replace(content_text, 'e', '3')) AS answer, "
        "CAST(NULL AS VARCHAR) AS answer_error FROM feedback WHERE lang = 'en' UNION ALL "
        "SELECT content_id, NULL, NULL FROM feedback WHERE lang <> 'en'"),
)
def ai_batch_model(spark, sf):
    rows = views.feedback(spark, sf)
    english = F.get_json_object("content_metadata", "$.language") == "en"
    text = F.when(english, F.col("content_text"))
    model = lambda: lambda texts: [t.replace("e", "3") for t in texts]
    answered = inference.infer(rows, text, "answer", model)
    return answered.select("content_id", F.md5("answer").alias("answer"), "answer_error")


@check(
    "ai_answer_store",
    sql(
        "SELECT content_id, CASE WHEN content_text IN (SELECT content_text FROM first_delivery) THEN 1 ELSE 2 END "
        "AS asked_in, md5(content_text) AS answer FROM second_delivery WHERE content_text IS NOT NULL"
    ),
)
def ai_answer_store(spark, sf):
    """Two deliveries: texts of the first are not asked again in the second, whose model would answer otherwise."""
    store = inference.AnswerStore(fresh_path(spark, "answer-store"), version="1")
    for run, delivery in ((1, views.first_delivery), (2, views.second_delivery)):
        model = lambda run=run: lambda texts: [f"{run}{t}" for t in texts]
        rows = delivery(spark, sf).where("content_text IS NOT NULL")
        answered = inference.infer(rows, F.col("content_text"), "answer", model, store=store)
        if run == 1:
            answered.agg(F.count("answer")).collect()
    asked_in = F.substr("answer", F.lit(1), F.lit(1)).cast("int").alias("asked_in")
    return answered.select("content_id", asked_in, F.md5(F.substr("answer", F.lit(2))).alias("answer"))


_PROMPT = extraction_prompt().replace("'", "''")


@check(
    "extraction_prompts",
    sql(f"SELECT content_id, '{_PROMPT}' || content_text AS prompt FROM feedback"),
)
def extraction_prompts(spark, sf):
    prompt = inference.with_prompt(F.col("content_text")).alias("prompt")
    return views.feedback(spark, sf).select("content_id", prompt)
