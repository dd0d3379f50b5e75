"""Markdown out of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(column: Column) -> Column:
    """Text of one table cell: empty for NULL, on one line, bars escaped."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.replace(F.translate(text, "\r\n", "  "), F.lit("|"), F.lit("\\|"))


def line(*columns: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |"))


def head(names: Sequence[str]) -> str:
    return "| " + " | ".join(names) + " |\n|" + " --- |" * len(names)


def table(names: Sequence[str], lines: Column) -> Column:
    """Head and the lines of an array; NULL or no lines leave the head alone."""
    body = F.coalesce(F.transform(lines, lambda row: F.concat(F.lit("\n"), row)), F.array())
    return F.concat(F.lit(head(names)), F.array_join(body, ""))
