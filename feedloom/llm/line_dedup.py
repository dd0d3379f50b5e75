"""Remove repeated runs of lines: windows of three consecutive lines, found again anywhere.

Of a window that stands more than once in the corpus the first occurrence stays, by
document id and then by position. The lines that later occurrences cover are merged and
removed, so a passage of many lines goes as a whole. A later occurrence that
overlaps the first one in the same document covers only the lines after the first.

Defined cases: a NULL text stays NULL and an empty one empty; a text of fewer
than ``width`` lines has no window and stays; a window of blank lines, which hold nothing but ASCII white
space, does not count; a NULL id comes after all ids; rows alike in id and text are one document
and get the same result; an empty table gives an empty table. Other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.plans.staging import stage

#: White space of ASCII inside a line.
_WHITE = " \t\x0b\x0c\r"
#: Ids that are NULL come last.
_LAST = 2**63 - 1


def _identity(docs: DataFrame, doc_id: str, text: str) -> tuple:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)), F.xxhash64(F.col(text))


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc, body, at, h1, h2``: every window of lines, as 128 bits of hash."""
    doc, body = _identity(docs, doc_id, text)
    lines = docs.select(doc.alias("doc"), body.alias("body"), F.split(F.col(text), "\n").alias("lines"))
    lines = lines.filter(F.size("lines") >= width)

    def window(i):
        parts = [F.element_at("lines", i + k + 1) for k in range(width)]
        blank = F.lit(True)
        for part in parts:
            blank = blank & (F.trim(part, F.lit(_WHITE)) == "")
        return F.struct(
            i.alias("at"),
            F.xxhash64(*parts).alias("h1"),
            F.xxhash64(F.lit(width), *reversed(parts)).alias("h2"),
            blank.alias("blank"),
        )

    found = lines.select(
        "doc", "body", F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - width), window)).alias("w")
    )
    return found.filter(~F.col("w.blank")).select("doc", "body", "w.at", "w.h1", "w.h2")


def covered(found: DataFrame, width: int = 3) -> DataFrame:
    """``doc, body, gone``: the lines of each document that later occurrences cover.

    Windows are reduced to their first occurrence before they are shuffled. The
    join back to all occurrences has two plain exchanges, so that adaptive
    execution can split a window that stands in a third of the corpus.
    """
    first = (
        found.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc", "body", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("h1", "h2", "first")
    )
    first = stage(first, "line-windows-first")
    same = (F.col("doc") == F.col("first.doc")) & (F.col("body") == F.col("first.body"))
    start = F.when(same, F.greatest("at", F.col("first.at") + width)).otherwise(F.col("at"))
    later = (
        found.join(first, ["h1", "h2"])
        .filter(~(same & (F.col("at") == F.col("first.at"))))
        .select("doc", "body", start.alias("start"), (F.col("at") + width - 1).alias("stop"))
    )
    positions = later.filter("start <= stop").select("doc", "body", F.explode(F.sequence("start", "stop")).alias("line"))
    return positions.groupBy("doc", "body").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``docs`` without the repeated lines, and ``n_lines``, ``n_removed`` in ``_dedup``.

    Runs jobs: windows and first occurrences are written once.
    """
    found = stage(windows(docs, doc_id, text, width), "line-windows")
    gone = covered(found, width).select(
        F.col("doc").alias("_dedup_doc"), F.col("body").alias("_dedup_body"), F.col("gone").alias("_dedup_gone")
    )
    doc, body = _identity(docs, doc_id, text)
    lines = F.split(F.col(text), "\n")
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_dedup_gone"))
    cleaned = F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")
    joined = docs.join(gone, (doc == F.col("_dedup_doc")) & (body == F.col("_dedup_body")), "left")
    return joined.select(
        *[docs[c] if c != text else F.when(F.col("_dedup_gone").isNull(), docs[text]).otherwise(cleaned).alias(text) for c in docs.columns],
        F.struct(
            F.when(docs[text].isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
            F.when(F.col("_dedup_gone").isNull(), 0).otherwise(F.size("_dedup_gone")).cast("long").alias("n_removed"),
        ).alias("_dedup"),
    )
