"""Query over the near-duplicates among all documents."""

from __future__ import annotations

from feedloom.llm.registry import register, table
from feedloom.llm.simhash import near_duplicates


@register("op10_pigeonhole_simhash")
def op10_pigeonhole_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
