"""All queries of this package."""

from __future__ import annotations

from feedloom.llm import q_byte_bpe, q_conversation_trie, q_html_text, q_hyperminhash, q_inner_product, q_line_dedup, q_mixing, q_multiset_hash, q_pii, q_quality_mil, q_repair, q_resampling, q_simhash  # noqa: F401
from feedloom.llm.registry import ORACLES, QUERIES  # noqa: F401
