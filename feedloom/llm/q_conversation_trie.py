"""Query over the trie of all conversations, rebuilt so that many share their first turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.llm.conversation_trie import sequences, trie
from feedloom.llm.registry import register, table
from feedloom.llm.sql_crc import CRC_TABLE, crc32
from feedloom.plans.staging import stage

#: A conversation takes its first turns from one whose id divides by GROUP; fewer than HEADS of them.
GROUP, HEADS = 5, 9

SQL = f"""
WITH {CRC_TABLE}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT role, text, row_number() OVER (ORDER BY role, text) AS id FROM (SELECT DISTINCT role, text FROM turns)
), convs AS (
  SELECT conv_id, list(id ORDER BY n) AS own FROM turns JOIN ids USING (role, text) GROUP BY conv_id
), hashed AS (
  SELECT conv_id, own, ({crc32("CAST(conv_id AS VARCHAR)")} % {HEADS})::INT AS h FROM convs, crc_table
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[:c.h], c.own[c.h + 1:]) AS seq
  FROM hashed c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % {GROUP}
), prefixes AS (
  SELECT conv_id, seq[:d] AS node, len(seq) = d AS ends
  FROM rebuilt, LATERAL (SELECT unnest(range(0, len(seq) + 1)) AS d)
), nodes AS (
  SELECT node, len(node) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), children AS (
  SELECT node[:-2] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), known AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         (n.n_convs - 1) * coalesce(octet_length(encode(i.text)), 0) AS saved
  FROM nodes n LEFT JOIN children c ON c.node = n.node LEFT JOIN ids i ON i.id = n.node[-1]
), subtrees AS (
  SELECT node[:d] AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM known, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY 1
)
SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs::BIGINT AS n_convs,
       k.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN subtrees s ON s.node = k.node
LEFT JOIN nodes p ON k.depth > 0 AND p.node = k.node[:-2]
"""


@register("op13_conversation_trie", SQL)
def op13_conversation_trie(spark, sf_dir):
    own = stage(sequences(table(spark, sf_dir, "conversations")), "trie-conversations")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    heads = heads.where(F.col("base") % GROUP == 0)
    n_taken = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    both = own.withColumn("n_taken", n_taken).join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base"), "left")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("n_taken"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("n_taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return trie(both.select("conv_id", F.concat(head, rest).alias("turns")))
