"""Query that draws documents whose words are those of the benchmark."""

from __future__ import annotations

from feedloom.llm.registry import register, table
from feedloom.llm.resampling import resampled
from feedloom.llm.sql_crc import CRC_TABLE, crc32

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_GAIN = "floor(1000 * ln((t + 1) * (sum_s + 10000)::DOUBLE / ((s + 1) * (sum_t + 10000))))::BIGINT"

SQL = f"""
WITH {CRC_TABLE}, numbered AS (
  SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS words FROM documents
), own AS (
  SELECT n, word, count(*) AS times FROM (SELECT n, unnest(words) AS word FROM numbered) GROUP BY ALL
), wanted AS (
  SELECT word, count(*) AS times FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY ALL
), hashed AS (
  SELECT word, {crc32("word")} % 10000 AS bucket
  FROM (SELECT word FROM own UNION SELECT word FROM wanted), crc_table
), all_own AS (
  SELECT bucket, sum(times)::BIGINT AS s FROM own JOIN hashed USING (word) GROUP BY bucket
), all_wanted AS (
  SELECT bucket, sum(times)::BIGINT AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket
), counts AS (
  SELECT bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t,
         coalesce(sum(s) OVER (), 0)::BIGINT AS sum_s, coalesce(sum(t) OVER (), 0)::BIGINT AS sum_t
  FROM all_own FULL JOIN all_wanted USING (bucket)
), gain AS (
  SELECT bucket, {_GAIN} AS gain FROM counts
), weighed AS (
  SELECT n, sum(times)::BIGINT AS n_features, floor(sum(times * gain) / sum(times)::DOUBLE)::BIGINT AS weight
  FROM own JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY n
), scored AS (
  SELECT n, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM numbered LEFT JOIN weighed USING (n)
), final AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored
), drawn AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS fit
  FROM final WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= fit * 10 // 100 THEN rank END::BIGINT AS rank
FROM final LEFT JOIN drawn USING (n)
"""


@register("op12_importance_resampling", SQL)
def op12_importance_resampling(spark, sf_dir):
    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
