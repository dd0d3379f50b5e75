"""CRC-32 in SQL, for an engine without it: the table, and a digest of the UTF-8 bytes of a text."""

from __future__ import annotations

#: One row, ``entries``: the 256 entries of the table, by the polynomial.
CRC_TABLE = (
    "crc_table AS (SELECT list(v ORDER BY i) AS entries FROM (SELECT i, list_reduce(list_prepend(i, range(8)), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"
)


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text expression; ``crc_table`` must be among the tables it selects from."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    values = f"list_transform({pairs}, lambda b: ('0x' || b)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), {step}), 4294967295::BIGINT)"
