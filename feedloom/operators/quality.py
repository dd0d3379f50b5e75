"""Row rules: drop what breaks one, and count it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The rule of the parsed table.
VALID_OVERALL = {"valid_overall_sentiment": "overall IS NOT NULL"}


def _holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def expect_or_drop(
    df: DataFrame,
    rules: Mapping[str, str] = VALID_OVERALL,
    observation: Observation | None = None,
) -> DataFrame:
    """Rows that meet every rule. With ``observation``, the one pass that reads
    the rows also counts them and the violations of each rule."""
    if observation is not None:
        failed = [F.count_if(~_holds(c)).alias(name) for name, c in rules.items()]
        df = df.observe(observation, F.count("*").alias("rows"), *failed)
    for condition in rules.values():
        df = df.where(F.expr(condition))
    return df


def with_broken(df: DataFrame, rules: Mapping[str, str] = VALID_OVERALL) -> DataFrame:
    """Add ``broken``: the names of the rules a row breaks, in their order."""
    names = [F.when(~_holds(c), F.lit(name)) for name, c in rules.items()]
    return df.withColumn("broken", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def broken_metrics(marked: DataFrame, rules: Mapping[str, str] = VALID_OVERALL) -> dict[str, int]:
    """Rows and violations of each rule among rows of :func:`with_broken`; reads that one column."""
    failed = [F.count_if(F.array_contains("broken", name)).alias(f"rule_{n}") for n, name in enumerate(rules)]
    counts = marked.agg(F.count("*").alias("rows"), *failed).first()
    return {"rows": counts["rows"], **{name: counts[f"rule_{n}"] for n, name in enumerate(rules)}}


def expect_metrics(df: DataFrame, rules: Mapping[str, str] = VALID_OVERALL) -> DataFrame:
    """Passed and dropped rows per rule, as a table."""
    counts = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(_holds(c)).alias("passed"),
            F.count_if(~_holds(c)).alias("dropped"),
        )
        for name, c in rules.items()
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
