"""Exact search for the largest inner products, pruned by lengths and partial sums.

Vectors are turned into whole numbers, so scores are exact. Candidates are put in blocks by
descending length. A query starts with the k-th best score among a bounded sample and
visits only blocks whose longest vector can still reach it (Cauchy-Schwarz). Inside a
block both sides are rotated by the singular vectors of all candidates, so that the first
coordinates hold most of each product: a candidate is dropped when its partial sum plus
the product of what is left of both lengths stays below the score to reach, which rises
as candidates are met. What is left is scored in full.

Defined cases: vectors that are NULL or hold a component that is NULL or not finite take
no part, nor do rows without id; shorter vectors count as zero in missing components; a query does not
meet rows of its own id, and of several query rows of one id the smallest vector asks; other rows
that repeat an id each count; ties go to smaller ids; fewer candidates than k are all
returned; an empty table gives an empty table. Scores are exact while they fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.plans.staging import stage

_EXACT = 2.0**52
_FIELDS = "query_id long, vec_id long, score long"


def scaled(vector: Column, factor: int = 1024) -> Column:
    """Components times ``factor``, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def usable(vector: Column) -> Column:
    def good(x):
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    return vector.isNotNull() & F.forall(vector, good)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of equal width."""
    values, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    out = np.zeros((len(column), width), np.int64)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = values
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, by falling singular value; width x width sums reach the driver."""

    def run(batches):
        gram = np.zeros((width, width))
        for batch in batches:
            v = _matrix(batch.column(0), width).astype(float)
            gram += v.T @ v
        at = np.flatnonzero(gram)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(gram.ravel()[at])], names=["at", "x"])

    sums = rows.select("v").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    gram = np.zeros(width * width)
    gram[sums["at"].to_numpy()] = sums["x"].to_numpy()
    _, vectors = np.linalg.eigh(gram.reshape(width, width))
    return np.ascontiguousarray(vectors[:, ::-1])


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two sets of whole numbers."""
    high = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if high < _EXACT:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    return q @ c.T


def best(
    q_ids: np.ndarray, q: np.ndarray, reach: np.ndarray, ids: np.ndarray, c: np.ndarray,
    turn: np.ndarray, k: int, first: int, step: int = 2048,
) -> list[tuple[int, int, int]]:
    """The k best candidates of one block for each query, of those that reach a score.

    Candidates come by descending length; ``turn`` rotates, the first ``first``
    coordinates are summed before the bound is taken.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in q_ids]
    q_turned = q @ turn
    q_rest = np.sqrt((q_turned[:, first:] ** 2).sum(1))
    reach = reach.astype(float).copy()
    for at in range(0, len(ids), step):
        own, own_ids = c[at : at + step], ids[at : at + step]
        turned = own @ turn
        rest = np.sqrt((turned[:, first:] ** 2).sum(1))
        bound = q_turned[:, :first] @ turned[:, :first].T + np.outer(q_rest, rest)
        bound += 1e-9 * (np.abs(bound) + 1) + 1e-6
        keep = (bound >= reach[:, None]) & (q_ids[:, None] != own_ids[None, :])
        asking = np.flatnonzero(keep.any(1))
        if not len(asking):
            continue
        left = np.flatnonzero(keep[asking].any(0))
        scores = _products(q[asking], own[left])
        for i, row in zip(asking.tolist(), scores, strict=True):
            mine = np.flatnonzero(keep[i][left] & (row >= reach[i]))
            if len(mine):
                if len(mine) > k:
                    mine = mine[np.lexsort((own_ids[left[mine]], -row[mine]))[:k]]
                merged = found[i] + list(zip((-row[mine]).tolist(), own_ids[left[mine]].tolist(), strict=True))
                found[i] = sorted(merged)[:k]
                if len(found[i]) == k:
                    reach[i] = max(reach[i], -found[i][-1][0])
    return [(int(q_id), vec_id, -score) for q_id, rows in zip(q_ids, found, strict=True) for score, vec_id in rows]


def top_products(
    vectors: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 10,
    factor: int = 1024,
    block: int = 16_384,
    sample: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of each query row with all other rows.

    ``queries`` says which rows ask. A row stays in its block of about ``block`` rows; a query is
    sent to the blocks it must visit. ``sample`` rows, half of them the longest and half by a
    hash, give the scores to start from; they and a line for each block reach the driver.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(embedding)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(embedding), factor).alias("v"), queries.alias("asks")
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = stage(rows.withColumn("length", F.sqrt(square)), "products-rows")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    width = max(1, width)
    turn = rotation(rows, width)
    first = max(1, width // 4)

    by_length = [F.col("length").desc(), F.col("vec_id")]
    placed = rows.repartitionByRange(max(1, -(-n // block)), *by_length).withColumn("block", F.spark_partition_id())
    placed = stage(placed, "products-blocks")
    longest = placed.groupBy("block").agg(F.max("length").alias("longest")).orderBy("block").collect()
    tops = np.array([r.longest for r in longest])
    ids_of_blocks = [r.block for r in longest]

    half = max(1, sample // 2)
    start = rows.orderBy(*by_length).limit(half).union(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(half))
    start = start.select("vec_id", "v").collect()
    pool = {}
    for r in start:
        pool.setdefault((r.vec_id, tuple(r.v)), r)
    pool_ids = np.array([key[0] for key in pool], np.int64)
    pool_rows = np.zeros((len(pool), width), np.int64)
    for i, (_, v) in enumerate(pool):
        pool_rows[i, : len(v)] = v
    lowest = float(-(2**63))

    def begin(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            q = _matrix(batch.column(1), width)
            lengths = batch.column(2).to_numpy()
            reach, last = np.full(len(ids), lowest), np.full(len(ids), len(tops) - 1)
            for at in range(0, len(ids), 256):
                part = slice(at, at + 256)
                scores = _products(q[part], pool_rows).astype(float)
                scores[ids[part][:, None] == pool_ids[None, :]] = -np.inf
                if scores.shape[1] >= k:
                    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                    reach[part] = np.where(np.isfinite(kth), kth, lowest)
            # Blocks fall by length, so those that can reach the score come first.
            can = lengths[:, None] * tops[None, :] * (1 + 1e-9) + 1e-6 >= reach[:, None]
            last = np.where(can.any(1), len(tops) - 1 - np.argmax(can[:, ::-1], axis=1), -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(reach), pa.array(last.astype(np.int32))],
                names=["vec_id", "v", "reach", "last"],
            )

    asking = rows.filter("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    asking = asking.withColumn("length", F.sqrt(square))
    started = asking.mapInArrow(begin, "vec_id long, v array<long>, reach double, last int").filter("last >= 0")
    sent = started.select(
        F.explode(F.slice(F.lit(ids_of_blocks), 1, F.col("last") + 1)).alias("block"),
        F.lit(1).alias("kind"), "vec_id", "v", "reach", F.lit(0.0).alias("length"),
    )
    held = placed.select("block", F.lit(0).alias("kind"), "vec_id", "v", F.lit(lowest).alias("reach"), "length")
    dealt = held.unionByName(sent).repartitionById(max(ids_of_blocks) + 1, F.col("block"))
    dealt = dealt.sortWithinPartitions("block", "kind", F.col("length").desc(), "vec_id")

    def search(batches):
        at, ids, parts, ready = None, [], [], None
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # Runs of one block and kind.
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)], strict=True):
                if i == j:
                    continue
                if blocks[i] != at:
                    at, ids, parts, ready = blocks[i], [], [], None
                some = batch.slice(i, j - i)
                own_ids, own = some.column(2).to_numpy(), _matrix(some.column(3), width)
                if kinds[i] == 0:
                    ids.append(own_ids)
                    parts.append(own)
                    continue
                if ready is None:
                    ready = (np.concatenate(ids), np.concatenate(parts))
                reach = some.column(4).to_numpy()
                for a in range(0, len(own_ids), 256):
                    q = slice(a, a + 256)
                    found = best(own_ids[q], own[q], reach[q], *ready, turn, k, first)
                    columns = zip(*found, strict=True) if found else ([], [], [])
                    arrays = [pa.array(list(c), pa.int64()) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(search, _FIELDS)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
