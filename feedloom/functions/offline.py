"""Rule-based stand-ins for the models, in Spark expressions alone.

They need no service, give the same answer every time and never leave the JVM.
A real model goes in through :func:`feedloom.operators.inference.infer`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.rows import row_by_row
from feedloom.schemas import CATEGORIES

GLOSSARY: Mapping[str, Mapping[str, str]] = {
    "fr": {
        "le": "the", "la": "the", "les": "the", "un": "a", "une": "a", "et": "and",
        "de": "of", "des": "of", "est": "is", "pour": "for", "que": "that", "avec": "with",
        "jeu": "game", "bon": "good", "mauvais": "bad",
    },
    "de": {
        "der": "the", "die": "the", "das": "the", "ein": "a", "eine": "a", "und": "and",
        "von": "of", "ist": "is", "nicht": "not", "mit": "with", "zu": "to", "auf": "on",
        "spiel": "game", "gut": "good", "schlecht": "bad",
    },
    "es": {
        "el": "the", "la": "the", "los": "the", "las": "the", "un": "a", "una": "a",
        "y": "and", "de": "of", "es": "is", "que": "that", "con": "with", "para": "for",
        "juego": "game", "bueno": "good", "malo": "bad",
    },
}


@dataclass(frozen=True)
class Lexicon:
    """Words of praise and blame, words that name a category, words worth a topic."""

    positive: Sequence[str]
    negative: Sequence[str]
    categories: Mapping[str, Sequence[str]]
    other: Sequence[str] = field(default=())


LEXICON = Lexicon(
    positive=("good", "great", "love", "fun", "best", "amazing", "enjoy", "smooth", "fair"),
    negative=("bad", "hate", "worst", "boring", "broken", "unfair", "annoying", "slow", "refund"),
    categories={
        "gameplay_mechanics": ("gameplay", "controls", "combat", "mechanics"),
        "matchmaking_game_balance": ("matchmaking", "balance", "ranked", "overpowered"),
        "game_performance": ("lag", "fps", "performance", "stutter"),
        "replayability": ("replay", "endgame", "repetitive"),
        "character": ("character", "hero", "villain", "skin"),
        "monetization": ("price", "microtransactions", "lootbox", "expensive", "gacha"),
        "bugs_glitches_techissues": ("bug", "crash", "glitch", "freeze"),
        "graphics_audio": ("graphics", "music", "sound", "art"),
        "suggestion_feedback": ("suggest", "wish", "should", "please"),
        "account_issues": ("account", "login", "password", "banned"),
        "cheating_hacking": ("cheater", "hacker", "aimbot", "cheating"),
        "toxicity": ("toxic", "harassment", "insult", "troll"),
        "player_retention": ("quit", "uninstall", "returning", "addicted"),
        "onboarding": ("tutorial", "beginner", "onboarding", "newbie"),
    },
    other=("story", "price", "update", "community", "server"),
)


@row_by_row
def glossary_translate(
    df: DataFrame,
    text_col: str = "content_text",
    out_col: str = "translated_content_text",
    *,
    language: Column,
    glossary: Mapping[str, Mapping[str, str]] = GLOSSARY,
) -> DataFrame:
    """Replace known words, keeping line breaks and closing punctuation.

    A text in a language without a glossary, or in none, stays as it is.
    """
    books = F.create_map(
        *[
            part
            for code, words in glossary.items()
            for part in (F.lit(code), F.create_map(*[F.lit(w) for pair in words.items() for w in pair]))
        ]
    )

    def translate_word(word: Column) -> Column:
        stem = F.rtrim(word, F.lit(".,!?;:"))
        known = F.try_element_at(F.col("_book"), F.lower(stem))
        ending = F.substr(word, F.length(stem) + 1)
        return F.coalesce(F.concat(known, ending), word)

    def translate_line(row: Column) -> Column:
        return F.array_join(F.transform(F.split(row, " "), translate_word), " ")

    lines = F.split(text_col, "\n")
    translated = F.array_join(F.transform(lines, translate_line), "\n")
    with_book = df.withColumn("_book", F.try_element_at(books, language))
    text = F.when(F.col("_book").isNull(), F.col(text_col)).otherwise(translated)
    return with_book.withColumn(out_col, text).drop("_book")


@row_by_row
def lexicon_extract(
    df: DataFrame,
    text_col: str = "content_text",
    out_col: str = "content_topic",
    *,
    lexicon: Lexicon = LEXICON,
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """Answer the extraction prompt by counting words of the lexicon.

    A category is mentioned if one of its words occurs; the first such word in
    the lexicon is its sub-topic. Praise against blame, each word once, gives
    the sentiment of the text and of all it mentions.
    """

    def words(known: Sequence[str]) -> Column:
        return F.array(*[F.lit(w) for w in known]).cast("array<string>")

    per_category = [lexicon.categories.get(c, ()) for c in categories]
    known = {*lexicon.positive, *lexicon.negative, *lexicon.other}.union(*per_category)
    spoken = F.split(F.lower(text_col), "[^a-z0-9]+")
    hits = F.array_intersect(spoken, words(sorted(known)))

    def mentioned(some: Sequence[str]) -> Column:
        return F.array_intersect(words(some), F.col("_hits"))

    praise, blame = F.size(mentioned(lexicon.positive)), F.size(mentioned(lexicon.negative))
    overall = (
        F.when(F.trim(text_col) == "", None)
        .when(praise > blame, "positive")
        .when(blame > praise, "negative")
        .otherwise("neutral")
    )
    found = [F.try_element_at(mentioned(some), F.lit(1)) for some in per_category]
    subjects = F.concat_ws(", ", *found)
    summary = F.concat(
        F.col("_overall"), F.when(subjects != "", F.concat(F.lit(": "), subjects)).otherwise("")
    )
    per_field = [
        F.when(
            word.isNotNull(),
            F.struct(F.col("_overall").alias("sentiment"), word.alias("sub_topic")),
        ).alias(category)
        for category, word in zip(categories, found)
    ]
    other = F.transform(
        mentioned(lexicon.other),
        lambda word: F.struct(word.alias("topic"), F.col("_overall").alias("sentiment")),
    )
    answer = F.to_json(
        F.struct(F.col("_overall").alias("overall"), summary.alias("summary"), *per_field, other.alias("other"))
    )
    return (
        df.withColumn("_hits", hits)
        .withColumn("_overall", overall)
        .withColumn(out_col, F.when(F.col(text_col).isNotNull(), answer))
        .drop("_hits", "_overall")
    )
