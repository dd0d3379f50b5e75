"""Query over all documents, encoded and decoded."""

from __future__ import annotations

import public_tokenizers

from feedloom.llm.byte_bpe import digests
from feedloom.llm.registry import register, table

RANKS = "byte_bpe_50k.tiktoken"


@register("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
