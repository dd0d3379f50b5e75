"""Query over the main text of all pages."""

from __future__ import annotations

from feedloom.llm.html_text import extract
from feedloom.llm.registry import register, table


@register("op9_text_density")
def op9_text_density(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
