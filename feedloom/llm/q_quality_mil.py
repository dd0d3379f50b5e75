"""Query over the quality of all documents."""

from __future__ import annotations

from feedloom.llm.quality_mil import report
from feedloom.llm.registry import register, table


@register("op4_attention_mil")
def op4_attention_mil(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
