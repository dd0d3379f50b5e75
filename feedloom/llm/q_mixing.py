"""Query over the mix of all documents."""

from __future__ import annotations

from feedloom.llm.mixing import mixed_sizes
from feedloom.llm.registry import register, table

SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS body,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), placed AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR || ':' || body), 1, 15))::BIGINT AS place
  FROM sized
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
  FROM sized GROUP BY source
), sources AS (
  SELECT *, n % 3 + 1 AS weight, (sum(source_size) OVER ())::BIGINT AS budget FROM weighed
), room AS (
  SELECT *,
    budget - coalesce(sum(cap) OVER before, 0) AS remains,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, remains * weight > cap * open_weight AS capped FROM room
), shares AS (
  SELECT source, source_size, budget,
    CASE WHEN capped THEN cap::DOUBLE
         ELSE ((budget - coalesce(sum(cap) FILTER (capped) OVER (), 0)) * weight)::DOUBLE
              / (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE END AS target
  FROM marked
), run AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS run
  FROM placed
), timed AS (
  SELECT r.source, r.place, r.doc_id, r.size, e.epoch, s.budget,
    CASE WHEN s.target > 0 THEN (e.epoch * s.source_size + r.run)::DOUBLE / s.target ELSE 0 END AS finish
  FROM run r JOIN shares s ON r.source IS NOT DISTINCT FROM s.source, (VALUES (0), (1), (2)) e(epoch)
), totals AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, doc_id, source NULLS LAST, size, epoch
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM timed
), ends AS (
  SELECT source, max(epoch) AS epoch, arg_max(place, (epoch, place)) AS last
  FROM totals WHERE total <= budget GROUP BY source
)
SELECT p.doc_id, p.size, s.source_size, s.target,
       (p.size * (coalesce(e.epoch, 0) + CASE WHEN p.place <= coalesce(e.last, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed p
JOIN shares s ON p.source IS NOT DISTINCT FROM s.source
LEFT JOIN ends e ON p.source IS NOT DISTINCT FROM e.source
"""


@register("op3_fair_queue_mix", SQL)
def op3_fair_queue_mix(spark, sf_dir):
    return mixed_sizes(table(spark, sf_dir, "documents"))
