"""A text column through a model, on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.prompts import extraction_prompt
from feedloom.operators.hashed import HashedRows
from feedloom.plans.staging import stage
from feedloom.schemas import CATEGORIES

Model = Callable[[Sequence[str]], Sequence[str | None]]

# Defaults of ``infer``; results do not depend on them.
HOT_SHARE = 1000
TEXTS_PER_TASK = 256
# Answers to hot texts are broadcast up to so many characters.
BROADCAST_CHARS = 16_000_000


@dataclass(frozen=True)
class AnswerStore:
    """Answers kept in a folder, so that no text is asked twice with the same directions and ``version`` of a model.

    They are found by the 128-bit hash of the text; a batch reads only buckets that may hold one of its
    texts. Errors are not kept. One writer at a time.
    """

    folder: str
    version: str = ""

    def rows(self, spark: SparkSession, directions: str) -> HashedRows:
        own = md5(f"{len(self.version)} {self.version}{directions}".encode()).hexdigest()
        return HashedRows(spark, f"{self.folder.rstrip('/')}/{own}", _STORED, ["_digest"])


_STORED = T.StructType([T.StructField("_digest", T.StringType()), T.StructField("_answer", T.StringType())])


def infer(
    df: DataFrame,
    text: Column,
    out_col: str,
    load_model: Callable[[], Model],
    *,
    id_col: str = "content_id",
    directions: str = "",
    tasks: int | None = None,
    texts_per_task: int = TEXTS_PER_TASK,
    batch_size: int = 64,
    hot_share: int = HOT_SHARE,
    store: AnswerStore | None = None,
) -> DataFrame:
    """Add ``out_col``, the model's answer to ``directions`` and ``text``, and ``<out_col>_error``.

    ``load_model`` runs once per task and returns a function from a list of
    texts to a list of answers. Every distinct text is asked once, ``batch_size``
    at a time; answers are written down before anything reads them, so that
    neither a second action nor a lost executor asks again. Distinct texts are
    written down too and dealt to tasks by their number, since they are small in
    bytes and slow to answer: ``tasks`` of them, or as many as ``texts_per_task``
    needs and at least one for each core. A NULL text has a NULL answer. If a
    batch fails its texts are asked one by one, and those that still fail get a
    NULL answer and the error. With a ``store``, texts it has an answer to are not asked, and the
    answers to all others are added to it.
    """
    keyed = df.withColumn("_text", text).withColumn("_digest", F.md5("_text"))
    texts = keyed.where("_text IS NOT NULL").groupBy("_text").agg(F.count("*").alias("_copies"))
    texts = stage(texts.withColumn("_digest", F.md5("_text")), "texts")
    kept = known = None
    if store is not None:
        kept = store.rows(df.sparkSession, directions)
        known = _kept_answers(kept, texts)
    left = texts if known is None else texts.join(known.select("_digest"), "_digest", "left_anti")
    if tasks is None:
        n = left.count()
        tasks = max(1, -(-n // texts_per_task), min(n, df.sparkSession.sparkContext.defaultParallelism))
    asked = left.select("_text", "_copies").repartition(tasks)
    answers = stage(asked.mapInPandas(_asker(load_model, batch_size, directions), _ANSWERS), "answers")
    if kept is not None:
        kept.add(answers.where("_error IS NULL"), 1 + max((r.last for r in kept.runs()), default=0))
    if known is not None:
        answers = answers.unionByName(known)
    return _look_up(keyed.drop("_text"), answers, out_col, id_col, hot_share)


def _kept_answers(kept: HashedRows, texts: DataFrame) -> DataFrame | None:
    """Answers to ``texts`` that are kept already, written down; NULL if there are none."""
    asked = texts.select("_digest", "_copies")
    found = kept.candidates(asked)
    if found is None:
        return None
    # After a crash a text may have been asked again: one of its answers counts.
    one = found.join(asked, "_digest", "left_semi").groupBy("_digest").agg(F.min_by("_answer", "_run").alias("_answer"))
    one = one.join(asked, "_digest").withColumn("_error", F.lit(None).cast("string"))
    return stage(one.select("_digest", "_copies", "_answer", "_error"), "kept-answers")


_ANSWERS = "_digest string, _copies long, _answer string, _error string"


def _asker(
    load_model: Callable[[], Model], batch_size: int, directions: str
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    # Nested, and built on pandas alone, so that executors need no copy of this package.
    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import md5

        import pandas as pd

        model = load_model()

        def ask_one(text):
            try:
                return list(model([text]))[0], None
            except Exception as error:
                return None, f"{type(error).__name__}: {error}"

        def ask_batch(texts):
            try:
                answers = list(model(texts))
                if len(answers) != len(texts):
                    raise ValueError("the model must give one answer per text")
                return [(answer, None) for answer in answers]
            except Exception:
                return [ask_one(text) for text in texts]

        for frame in frames:
            texts = frame["_text"].tolist()
            results = []
            for start in range(0, len(texts), batch_size):
                results += ask_batch([directions + t for t in texts[start : start + batch_size]])
            yield pd.DataFrame(
                {
                    "_digest": [md5(text.encode()).hexdigest() for text in texts],
                    "_copies": frame["_copies"],
                    "_answer": pd.Series([r[0] for r in results], dtype=object),
                    "_error": pd.Series([r[1] for r in results], dtype=object),
                }
            )

    return ask


def _look_up(
    keyed: DataFrame, answers: DataFrame, out_col: str, id_col: str, hot_share: int
) -> DataFrame:
    """Answers back onto the rows. A text of more than one in ``hot_share`` rows is hot.

    There are fewer than ``hot_share`` of these; their answers are broadcast if their
    size, which is counted, allows it. No other text has enough rows to overload a task.
    """
    size = F.coalesce(F.length("_answer"), F.lit(0)) + F.coalesce(F.length("_error"), F.lit(0))
    rows, chars = (n or 0 for n in answers.agg(F.sum("_copies"), F.sum(size + 32)).first())
    is_hot = F.col("_copies") * hot_share > rows
    small = (answers.where(is_hot).agg(F.sum(size)).first()[0] or 0) <= BROADCAST_CHARS
    columns = ["_digest", "_answer", "_error"]
    hot = answers.where(is_hot).select(*columns)
    cold = answers.where(~is_hot).select(*columns)
    hot = hot.withColumnsRenamed({"_digest": "_hot", "_answer": "_hot_answer", "_error": "_hot_error"})
    cold = cold.withColumnRenamed("_digest", "_key")
    # Where rows have to be shuffled to their answers, they are not sorted as well: a task's answers fit.
    cold = cold.hint("shuffle_hash") if chars > BROADCAST_CHARS else cold

    hot = F.broadcast(hot) if small else hot
    seen = keyed.join(hot, F.col("_digest") == F.col("_hot"), "left")
    # Rows already answered, and rows without a text, match nothing below: spread them out.
    spread = F.concat_ws("#", F.lit(""), F.col(id_col))
    settled = F.col("_hot").isNotNull() | F.col("_digest").isNull()
    seen = seen.withColumn("_key", F.when(settled, spread).otherwise(F.col("_digest")))
    joined = seen.join(cold, "_key", "left")
    return joined.select(
        *[c for c in keyed.columns if c != "_digest"],
        F.coalesce("_hot_answer", "_answer").alias(out_col),
        F.coalesce("_hot_error", "_error").alias(f"{out_col}_error"),
    )


def translate(df: DataFrame, load_model: Callable[[], Model], **options: object) -> DataFrame:
    """The text in English beside the original."""
    return infer(df, F.col("content_text"), "translated_content_text", load_model, **options)


def extract(
    df: DataFrame,
    load_model: Callable[[], Model],
    *,
    categories: Sequence[str] = CATEGORIES,
    text_col: str = "content_text",
    **options: object,
) -> DataFrame:
    """Sentiment and topics of the text as JSON."""
    directions = extraction_prompt(categories)
    text = F.col(text_col)
    return infer(df, text, "content_topic", load_model, directions=directions, **options)


def with_prompt(text: Column, categories: Sequence[str] = CATEGORIES) -> Column:
    """The directions followed by the text; NULL for a NULL text."""
    return F.concat(F.lit(extraction_prompt(categories)), text)
