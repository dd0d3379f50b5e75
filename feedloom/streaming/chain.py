"""Incremental enrichment: every table a stream over the one before it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom import schemas
from feedloom.functions.offline import glossary_translate, lexicon_extract
from feedloom.functions.rows import is_row_by_row, row_by_row
from feedloom.operators import extraction
from feedloom.operators.merge import known_keys, unknown_rows
from feedloom.operators.quality import VALID_OVERALL, broken_metrics, with_broken
from feedloom.operators.tables import (
    batch_name,
    compact,
    create_item_table,
    item_table_schema,
    location,
    write_batch,
)
from feedloom.plans.staging import scratch, shared_dir, stage

Transform = Callable[[DataFrame], DataFrame]
# Makes of a batch what the table gets and what is set aside.
Divide = Callable[[DataFrame], tuple[DataFrame, DataFrame]]

# Table names other systems read.
BRONZE = "feedback_content_bronze"
TRANSLATED = "feedback_content_translated"
EXTRACTED = "feedback_content_ai_extraction"
PARSED = "feedback_content_parsed"
ITEMS = "feedback_content_gold"
TOPICS = "feedback_content_sentiment_gold"
REPORTS = "feedback_content_reports"
# Not among them: rows that broke a rule.
QUARANTINE = "feedback_content_quarantine"

# Up to this many games of a batch are listed to find their partitions; others are found by the key.
MAX_LISTED_GAMES = 1000

# No file is too old to be read, whatever arrived before it.
MAX_FILE_AGE = "36500d"

# One store writes languages out.
LANGUAGE_NAMES = {"french": "fr", "german": "de", "spanish": "es", "latam": "es"}


@row_by_row
def translate_offline(df: DataFrame) -> DataFrame:
    """By glossary, in the language the source recorded, if it did."""
    recorded = F.get_json_object("content_metadata", "$.language")
    names = F.create_map(*[F.lit(word) for pair in LANGUAGE_NAMES.items() for word in pair])
    language = F.coalesce(F.try_element_at(names, recorded), recorded)
    return glossary_translate(df, language=language)


@dataclass(frozen=True)
class Chain:
    """What a chain runs on: a database, where checkpoints go, and the models."""

    database: str
    checkpoints: str | None = None
    translate: Transform = translate_offline
    extract: Transform = lexicon_extract
    categories: Sequence[str] = schemas.CATEGORIES
    rules: Mapping[str, str] = field(default_factory=lambda: dict(VALID_OVERALL))
    files_per_batch: int | None = None
    # Called after a run with the rows and the violations of each rule, per parsed batch.
    on_quality: Callable[[Mapping[str, int]], None] | None = None
    # Whether rows that break a rule are kept in a table of their own, with the names of the rules.
    quarantine: bool = False
    # What makes an item one and the same, in all tables; ``game_name`` always belongs to it downstream.
    keys: Sequence[str] = ("content_id",)
    # Tables of more batches are compacted after a run, so that listings do not grow with runs.
    most_batches: int = 100

    def table(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"


def new_rows(
    spark: SparkSession, table: str, ddl: str, files_per_batch: int | None = None
) -> DataFrame:
    """Rows added to an item table since the last run of the reading stream.

    Only new files are read. Removing a game's partitions upstream is neither an
    error nor passed on.
    """
    reader = spark.readStream.schema(item_table_schema(ddl)).option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(location(spark, table)).drop("batch_id")


def append_table(
    source: DataFrame,
    table: str,
    ddl: str,
    transform: Transform,
    checkpoint: str,
    keys: Sequence[str] = ("content_id",),
    aside: tuple[str, str, Divide] | None = None,
) -> StreamingQuery:
    """Start to bring ``table`` up to date with ``source``; the stream then ends.

    A batch replaces its own partitions, so one that was cut short leaves
    nothing behind. A replayed batch makes new files, which the next table sees
    again; rows whose key another batch of the same game holds are left out. What a
    batch stages is removed after its write. A transform marked as working row by row is not
    followed by a shuffle: a file of ``source`` holds one game. With ``aside``, a second table, its columns and what
    divides a batch in place of ``transform``, the second part goes there under the same rules.
    """
    spark = source.sparkSession
    create_item_table(spark, table, ddl)
    if aside is not None:
        create_item_table(spark, *aside[:2])

    def write(batch: DataFrame, number: int) -> None:
        name = batch_name(checkpoint, number)
        with scratch(batch.sparkSession):
            new, moved = _unseen(batch, table, name, keys)
            if aside is None:
                write_batch(transform(new), table, name, spread=moved or not is_row_by_row(transform))
                return
            kept, rest = aside[2](new)
            rest, again = _unseen(rest, aside[0], name, keys)
            write_batch(rest, aside[0], name, spread=moved or again)
            write_batch(kept, table, name, spread=moved)

    stream = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def _unseen(batch: DataFrame, table: str, name: str, keys: Sequence[str]) -> tuple[DataFrame, bool]:
    """Rows whose key no other batch of the same game holds, NULL equals NULL; and whether they are shuffled for it.

    A batch of few games looks at their partitions only, which changes no result:
    the game is part of the key. Without any, as for a new game, nothing is read
    at all; otherwise the key columns are.
    """
    earlier = batch.sparkSession.table(table).where(F.col("batch_id") != name)
    games = batch.select("game_name").distinct().limit(MAX_LISTED_GAMES + 1).collect()
    if len(games) <= MAX_LISTED_GAMES:
        names = [row["game_name"] for row in games]
        own = F.col("game_name").isin([n for n in names if n is not None])
        earlier = earlier.where(own | F.col("game_name").isNull() if None in names else own)
    if earlier.isEmpty():
        return batch, False
    every = [*keys, *({"game_name"} - set(keys))]
    return unknown_rows(batch, known_keys(earlier, every), every)


def stages(chain: Chain) -> list[tuple[str, str, str, str, Transform]]:
    """Source table and columns, target table and columns, and what lies between."""
    parsed = schemas.parsed_ddl(chain.categories)
    # Topics name their item by id and game; a wider key is carried along.
    carried = [k for k in chain.keys if k not in ("content_id", "game_name")]
    kinds = {f.name: f.dataType.simpleString() for f in item_table_schema(parsed)}
    topics_ddl = ", ".join([schemas.TOPICS, *[f"`{k}` {kinds[k]}" for k in carried]])
    parse = partial(extraction.parsed, categories=chain.categories, rules=chain.rules)
    topics = partial(extraction.gold_topics, categories=chain.categories, carry=carried)
    return [
        (BRONZE, schemas.FEEDBACK, TRANSLATED, schemas.TRANSLATED, chain.translate),
        (TRANSLATED, schemas.TRANSLATED, EXTRACTED, schemas.EXTRACTED, chain.extract),
        (EXTRACTED, schemas.EXTRACTED, PARSED, parsed, parse),
        (PARSED, parsed, ITEMS, schemas.ITEMS, extraction.gold_items),
        (PARSED, parsed, TOPICS, topics_ddl, topics),
    ]


def _divided(chain: Chain, observed: list[Mapping[str, int]]) -> tuple[str, str, Divide]:
    """The quarantine table and how a batch is divided: parsed once, written down, then counted and split.

    If broken rows are only counted, nothing is written down: the count reads what the rules need, then kept rows are parsed.
    """

    def divide(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        wide = extraction.parsed_wide(batch, chain.categories)
        marked = with_broken(wide, chain.rules)
        marked = stage(marked, "marked") if chain.quarantine else marked
        if chain.on_quality is not None:
            observed.append(broken_metrics(marked, chain.rules))
        fine = F.size("broken") == 0
        rest = marked.where(~fine) if chain.quarantine else marked.limit(0)
        return marked.where(fine).drop("broken"), rest

    return chain.table(QUARANTINE), f"{schemas.parsed_ddl(chain.categories)}, broken array<string>", divide


def refresh(spark: SparkSession, chain: Chain) -> None:
    """Carry new bronze rows through all tables. Tables with the same source are
    filled side by side, the others one after the other.

    At the end every row has been seen by the streams that read it, and tables of many
    batches are compacted. One refresh runs at a time, and no upsert beside it.
    """
    checkpoints = checkpoints_of(spark, chain)
    observed: list[Mapping[str, int]] = []
    divided = _divided(chain, observed) if chain.quarantine or chain.on_quality is not None else None
    for source, group in groupby(stages(chain), key=itemgetter(0)):
        running = []
        try:
            for _, source_ddl, target, target_ddl, transform in group:
                rows = new_rows(spark, chain.table(source), source_ddl, chain.files_per_batch)
                checkpoint = f"{checkpoints}/{target}"
                name = chain.table(target)
                aside = divided if target == PARSED else None
                running.append(append_table(rows, name, target_ddl, transform, checkpoint, chain.keys, aside))
            for stream in running:
                stream.awaitTermination()
        finally:
            for stream in running:
                stream.stop()
    for name in (BRONZE, TRANSLATED, EXTRACTED, PARSED, ITEMS, TOPICS, *[QUARANTINE] * (divided is not None)):
        compact(spark, chain.table(name), chain.most_batches)
    for counts in observed:
        chain.on_quality(counts)


def checkpoints_of(spark: SparkSession, chain: Chain) -> str:
    return chain.checkpoints or f"{shared_dir(spark)}/{chain.database}-streams"


def enrich(bronze: DataFrame, chain: Chain) -> tuple[DataFrame, DataFrame]:
    """The same tables in one batch: items and topics of all bronze rows."""
    extracted = chain.extract(chain.translate(bronze))
    parsed = extraction.parsed(extracted, chain.categories, chain.rules)
    return extraction.gold_items(parsed), extraction.gold_topics(parsed, chain.categories)
