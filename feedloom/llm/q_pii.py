"""Query over the personal data of all documents."""

from __future__ import annotations

from feedloom.llm import pii
from feedloom.llm.registry import register, table

#: The same patterns without looking back; this engine's patterns need no help to be linear.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: len(ltrim(p, '0')) > 3 OR ('0' || right(ltrim(p, '0'), 3))::INT > 255)) = 0",
    "card": f"""len({_DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(0, len({_DIGITS})),
        lambda i: CASE WHEN i % 2 = 0 THEN substr({_DIGITS}, len({_DIGITS}) - i, 1)::INT
                  ELSE 2 * substr({_DIGITS}, len({_DIGITS}) - i, 1)::INT
                       - CASE WHEN substr({_DIGITS}, len({_DIGITS}) - i, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0""",
    "phone": f"len({_DIGITS}) BETWEEN 10 AND 15",
    "iban": """len(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(
        string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''),
        lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END)),
        lambda s, v: (s * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1""",
}


def _sql() -> str:
    parts = []
    for rank, kind in enumerate(pii.KINDS):
        near, against = ("(^|[^a-z])(" + "|".join(w) + ")([^a-z]|$)" for w in (kind.nearby, kind.against))
        parts.append(
            f"""
  SELECT doc_id, start, {rank} AS rank, '{kind.name}' AS kind, stop, {str(kind.base).lower()} AS base,
    least(100, greatest(0, {kind.score}
      + CASE WHEN regexp_matches(around, '{near}') THEN 25 ELSE 0 END
      - CASE WHEN regexp_matches(around, '{against}') THEN 25 ELSE 0 END)) AS score
  FROM (
    SELECT doc_id, m, stop - len(m) AS start, stop,
      lower(substr(text, greatest(stop - len(m) - {pii.BEFORE}, 0) + 1, least(stop - len(m), {pii.BEFORE}))
            || ' ' || substr(text, stop + 1, {pii.AFTER})) AS around
    FROM (
      SELECT doc_id, text, m, (sum(len(p) + len(m)) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS stop
      FROM (
        SELECT doc_id, text, unnest(ms) AS m, unnest(ps[:len(ms)]) AS p, unnest(range(0, len(ms))) AS i
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{_PLAIN[kind.name]}') AS ms,
                     string_split_regex(text, '{_PLAIN[kind.name]}') AS ps
              FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
      )
    ) WHERE {_VALID[kind.name]}
  )"""
        )
    counts = ", ".join(f"(count(*) FILTER (kind = '{k.name}'))::BIGINT AS n_{k.name}" for k in pii.KINDS if k.base)
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    return f"""
WITH found AS ({" UNION ALL ".join(parts)}
), kept AS (SELECT * FROM found WHERE base OR score >= 50),
grouped AS (
  SELECT doc_id, {counts}, coalesce({joined} FILTER (base), '') AS base_spans, {joined} AS spans,
    string_agg(kind || ':' || start || ':' || stop || ':' || score, ',' ORDER BY start, rank, stop) AS scored
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in pii.KINDS if k.base)},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scored, '') AS scored
FROM documents d LEFT JOIN grouped USING (doc_id)
"""


@register("op7_personal_data", _sql())
def op7_personal_data(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))
