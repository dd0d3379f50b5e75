"""From raw documents to token ids: five stages, each over all rows that its predecessor kept.

Each stage takes the session, documents and the folder of the given tables. All but the last return
rows with the columns of ``documents``. NULLs, empty texts and tables, and repeated rows are
treated as the operators of the stages say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import byte_bpe, line_dedup, mixing, quality_mil, simhash
from feedloom.llm.registry import table
from feedloom.plans.staging import stage

RANKS = "byte_bpe_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``labels`` and these documents."""
    return quality_mil.accepted(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier in the corpus; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs)
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cleaned.select(*columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of fingerprints within three bits, of three-word shingles."""
    return simhash.representatives(docs, radius=3, shingle=3)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document of the mix."""
    return byte_bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_similar),
    ("source mix", mix_to_weights),
    ("byte-level BPE", encode),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = stage(docs, f"pipeline-{n}")
    return docs
