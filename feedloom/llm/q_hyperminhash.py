"""Query over the near-duplicates by word shingles among all documents."""

from __future__ import annotations

from feedloom.llm.hyperminhash import near_duplicates
from feedloom.llm.registry import register, table


@register("op11_hyperminhash")
def op11_hyperminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
