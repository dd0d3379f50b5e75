"""Query over the ids of all documents, written to compressed shards and read back."""

from __future__ import annotations

import public_tokenizers

from feedloom.llm import repair
from feedloom.llm.registry import register, table

TOKENIZER = "word_bpe_49k.json"


@register("op1_repair_shards")
def op1_repair_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return repair.checked(spark, repair.write(docs, public_tokenizers.path(TOKENIZER)))
