"""Query over the largest inner products of every hundredth vector with all others."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.llm.inner_product import top_products
from feedloom.llm.registry import register, table

SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    (list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@register("op2_norm_sorted_products", SQL)
def op2_norm_sorted_products(spark, sf_dir):
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
