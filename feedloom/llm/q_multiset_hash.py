"""Query over the fingerprints of all documents."""

from __future__ import annotations

from feedloom.llm.multiset_hash import report
from feedloom.llm.registry import register, table


@register("op5_multiset_hash")
def op5_multiset_hash(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))
