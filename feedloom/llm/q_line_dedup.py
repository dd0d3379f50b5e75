"""Query over all documents without their repeated lines."""

from __future__ import annotations

from feedloom.llm.line_dedup import dedup_lines
from feedloom.llm.registry import register, table

SQL = r"""
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), positions AS (
  SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS pos FROM docs WHERE len(lines) >= 3
), found AS (
  SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS w
  FROM positions
  WHERE trim(lines[pos + 1] || lines[pos + 2] || lines[pos + 3], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), firsts AS (
  SELECT w, min((doc_id, pos)) AS f FROM found GROUP BY w HAVING count(*) > 1
), later AS (
  SELECT doc_id, CASE WHEN doc_id = f[1] THEN greatest(pos, f[2] + 3) ELSE pos END AS start, pos + 2 AS stop
  FROM found JOIN firsts USING (w) WHERE NOT (doc_id = f[1] AND pos = f[2])
), gone AS (
  SELECT doc_id, list(DISTINCT line) AS gone
  FROM (SELECT doc_id, unnest(range(start, stop + 1)) AS line FROM later WHERE start <= stop) GROUP BY doc_id
)
SELECT d.doc_id,
  CASE WHEN g.gone IS NULL THEN d.text
       ELSE coalesce(array_to_string([l for l, i in d.lines if NOT list_contains(g.gone, i - 1)], chr(10)), '') END AS text,
  coalesce(len(d.lines), 0)::BIGINT AS n_lines, coalesce(len(g.gone), 0)::BIGINT AS n_removed
FROM docs d LEFT JOIN gone g USING (doc_id)
"""


@register("op6_line_windows", SQL)
def op6_line_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "_dedup.n_lines", "_dedup.n_removed")
