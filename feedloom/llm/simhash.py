"""SimHash fingerprints and near-duplicates among them by the generalised pigeonhole principle.

A fingerprint has a bit for each of 64 majorities among the hashes of a text's word
shingles. Equal fingerprints are brought together first. For the others, the 64 bits are put
into parts so that correlated bits share a part. If two fingerprints differ in at
most ``radius`` bits and the thresholds of the parts add up to
``radius - parts + 1``, at least one part differs in no more bits than its threshold
(-1: the part is not probed). Each fingerprint gets the thresholds that dynamic
programming finds cheapest for it, by the number of probes and the candidates estimated
from counts over all fingerprints; it probes with all variants of its parts within
their thresholds, and candidates are verified. In a crowded region of one part
the search moves to the other. A fingerprint has a bounded number of distinct neighbours
however many documents there are, and copies of a text are one fingerprint.

Defined cases: a text without words, or NULL, has fingerprint zero and is linked like any
other; fewer words than a shingle has are hashed together; equal rows get equal results; a NULL id
counts for no component's smallest id, and a component without ids has NULL; an empty table
gives an empty table. Other columns are not looked at, or pass unchanged.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.components import components
from feedloom.plans.staging import stage

BITS = 64
SEED = 42
#: Candidates are estimated from the values of slices of so many bits; counts need 2^16 rows a slice at most.
SLICE = 16
_CHUNK = 100_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a whole text, as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return _majority(_ones(hashes), 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1]
    stops = ends[shingle - 1 :]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK].tolist(), stops[at : at + _CHUNK].tolist(), strict=True)
        ones += _ones(np.array([digest(joined[i:j], SEED) for i, j in spans], np.uint64))
    return _majority(ones, len(starts))


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set, the lowest bit first."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, body, fp`` of every document: a hash of its text, and the 64 bits as a signed long."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("body"), F.col(text).alias("text")
    )

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found)], names=["doc_id", "body", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, body long, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlations(distinct: DataFrame) -> np.ndarray:
    """Absolute correlation of every two bits over all fingerprints; 64 x 64 sums reach the driver."""

    def run(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            n_column = np.where(i == j, n, 0)
            columns = [pa.array(i), pa.array(j), pa.array(both.ravel().astype(np.int64)), pa.array(n_column)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n_both", "n"])

    sums = distinct.select("fp").mapInArrow(run, "i long, j long, n_both long, n long")
    rows = sums.groupBy("i", "j").agg(F.sum("n_both").alias("n_both"), F.sum("n").alias("n")).collect()
    both, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        both[r.i, r.j] = r.n_both
        n = max(n, r.n)
    if not n:
        return np.zeros((BITS, BITS))
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs((both / n - np.outer(mean, mean)) / np.outer(spread, spread))


def arrange(correlation: np.ndarray, parts: int = 2) -> list[int]:
    """The order of the bits: parts of equal length, each grown by the bit that is most correlated with it."""
    left, order, size = set(range(BITS)), [], BITS // parts
    while left:
        rest = sorted(left)
        strength = correlation[np.ix_(rest, rest)].sum(1)
        group = [rest[int(np.argmax(strength))]]
        left.remove(group[0])
        while left and len(group) < size:
            rest = sorted(left)
            bit = rest[int(np.argmax(correlation[np.ix_(rest, group)].sum(1)))]
            group.append(bit)
            left.remove(bit)
        order += group
    return order


def part_values(fps: np.ndarray, order: list[int], parts: int) -> np.ndarray:
    """The bits of each part as a number, one column per part."""
    size = BITS // parts
    bits = _bits(fps)[:, order].reshape(len(fps), parts, size)
    padded = np.zeros((len(fps), parts, BITS), np.uint8)
    padded[:, :, :size] = bits
    return np.packbits(padded, axis=2, bitorder="little").reshape(len(fps), parts, 8).view("<u8").reshape(len(fps), parts).astype(np.int64)


def near_counts(distinct: DataFrame, order: list[int], radius: int) -> tuple[np.ndarray, int]:
    """For each slice and value: how many fingerprints differ there in 0, 1, ... ``radius`` bits; and their number.

    Counts cover all fingerprints; at most 4 x 2^16 of them reach the driver.
    """
    slices = BITS // SLICE

    def run(batches):
        counts = np.zeros((slices, 1 << SLICE), np.int64)
        for batch in batches:
            values = part_values(batch.column(0).to_numpy(), order, slices)
            for s in range(slices):
                counts[s] += np.bincount(values[:, s], minlength=1 << SLICE)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], names=["at", "n"])

    rows = distinct.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(slices << SLICE)
    counts[rows["at"].to_numpy()] = rows["n"].to_numpy()
    counts = counts.reshape(slices, 1 << SLICE)
    near = np.zeros((slices, 1 << SLICE, radius + 1), np.float32)
    every = np.arange(1 << SLICE)
    for d in range(radius + 1):
        for mask in masks(SLICE, d, exactly=True):
            near[:, :, d] += counts[:, every ^ mask]
    return near, int(counts[0].sum())


def masks(bits: int, within: int, exactly: bool = False) -> np.ndarray:
    """Numbers with at most (or exactly) so many of the lowest ``bits`` set."""
    sizes = [within] if exactly else range(within + 1)
    return np.array([sum(1 << b for b in c) for k in sizes for c in combinations(range(bits), k)], np.int64)


def thresholds(values: np.ndarray, near: np.ndarray, n: int, radius: int, parts: int) -> np.ndarray:
    """The cheapest thresholds for each fingerprint, one column per part, by dynamic programming.

    ``values`` has a column per slice. A threshold costs its probes and the candidates
    estimated for them, as if the slices of a part were independent.
    """
    per = BITS // SLICE // parts
    rows, size = len(values), BITS // parts
    probes = [len(masks(size, t)) for t in range(radius + 1)]
    cost = np.zeros((rows, parts, radius + 2))  # a threshold of -1 comes first and costs nothing
    for p in range(parts):
        exact = None
        for s in range(p * per, (p + 1) * per):
            here = near[s][values[:, s]].astype(float)
            if exact is None:
                exact = here
                continue
            mixed = np.zeros_like(exact)
            for d in range(radius + 1):
                for e in range(d + 1):
                    mixed[:, d] += exact[:, e] * here[:, d - e] / max(n, 1)
            exact = mixed
        cost[:, p, 1:] = np.cumsum(exact, axis=1) + probes
    total = radius - parts + 1 + parts  # thresholds counted from -1
    best = np.full((rows, total + 1), np.inf)
    best[:, 0] = 0
    chosen = np.zeros((rows, parts, total + 1), np.int64)
    for p in range(parts):
        grown = np.full_like(best, np.inf)
        for t in range(min(radius + 1, total) + 1):
            for have in range(total + 1 - t):
                new = best[:, have] + cost[:, p, t]
                better = new < grown[:, have + t]
                grown[better, have + t] = new[better]
                chosen[better, p, have + t] = t
        best = grown
    out, at = np.zeros((rows, parts), np.int64), np.full(rows, total)
    for p in range(parts - 1, -1, -1):
        out[:, p] = chosen[np.arange(rows), p, at]
        at -= out[:, p]
    return out - 1


def links(distinct: DataFrame, radius: int = 3, parts: int = 2) -> DataFrame:
    """``a, b``: every two different fingerprints that differ in at most ``radius`` bits, ``a < b``.

    ``distinct`` has each fingerprint once, in ``fp``. Runs two jobs for the counts.
    """
    order = arrange(correlations(distinct), parts)
    near, n = near_counts(distinct, order, radius)
    size = BITS // parts
    spark = distinct.sparkSession
    counts = spark.sparkContext.broadcast(near)  # 4 x 2^16 values for each distance, whatever the input

    def index(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy()
            values = part_values(fps, order, parts)
            for p in range(parts):
                yield _pairs(values[:, p] + _tag(p, size), fps)

    def probe(batches):
        variants = [masks(size, t) for t in range(radius + 1)]
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                fps = batch.column(0).slice(start, 2000).to_numpy()
                values = part_values(fps, order, parts)
                chosen = thresholds(part_values(fps, order, BITS // SLICE), counts.value, n, radius, parts)
                for p in range(parts):
                    for t in range(radius + 1):
                        rows = chosen[:, p] == t
                        if rows.any():
                            keys = (values[rows, p][:, None] ^ variants[t][None, :]) + _tag(p, size)
                            yield _pairs(keys.ravel(), np.repeat(fps[rows], len(variants[t])))

    indexed = distinct.select("fp").mapInArrow(index, "key long, fp long")
    probed = distinct.select("fp").mapInArrow(probe, "key long, fp long").withColumnRenamed("fp", "asks")
    near_by = F.bit_count(F.col("fp").bitwiseXOR(F.col("asks"))) <= radius
    found = probed.join(indexed, (probed["key"] == indexed["key"]) & near_by & (F.col("fp") != F.col("asks")))
    return found.select(F.least("fp", "asks").alias("a"), F.greatest("fp", "asks").alias("b")).distinct()


def _tag(part: int, size: int) -> int:
    """Keeps the keys of parts apart."""
    return part << size if size < 62 else 0


def _pairs(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps)], names=["key", "fp"])


def classes(rows: DataFrame, radius: int = 3, parts: int = 2) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``doc_id, fp`` rows, written once."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "simhash-distinct")
    rooted = components(links(distinct, radius, parts), "a", "b")
    known = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    known = stage(known, "simhash-roots")
    smallest = stage(known.groupBy("root").agg(F.min("smallest").alias("component_id")), "simhash-smallest")
    return stage(known.join(smallest, "root").select("fp", "root", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    A fingerprint of very many copies is split by adaptive execution in the last join:
    both its sides are plain exchanges over written tables.
    """
    rows = stage(fingerprints(docs, doc_id, text, shingle), "simhash-rows")
    known = classes(rows, radius)
    return rows.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, the one of smallest id, all columns kept.

    Rows are told apart by id and text. Of rows that repeat both, and of rows of one
    group that share the smallest id, one stays.
    """
    rows = stage(fingerprints(docs, doc_id, text, shingle), "simhash-rows")
    known = classes(rows, radius)
    smallest = rows.join(known, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return one_of_each(docs, smallest.groupBy("root").agg(F.min(F.struct("doc_id", "body")).alias("one")), doc_id, text)


def one_of_each(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of ``docs`` for each row of ``chosen``, whose ``one`` has an id and the hash of a text."""
    chosen = stage(
        chosen.select(F.col("one.doc_id").alias("_simhash_id"), F.col("one.body").alias("_simhash_body")).distinct(),
        "simhash-chosen",
    )
    keyed = docs.withColumns({"_simhash_own": F.col(doc_id), "_simhash_hash": F.xxhash64(F.col(text))})
    kept = keyed.join(
        chosen,
        keyed["_simhash_own"].eqNullSafe(chosen["_simhash_id"]) & (keyed["_simhash_hash"] == chosen["_simhash_body"]),
    )
    again = Window.partitionBy("_simhash_own", "_simhash_hash").orderBy("_simhash_hash")
    kept = kept.withColumn("_simhash_copy", F.row_number().over(again)).filter("_simhash_copy = 1")
    return kept.select(*[docs[c] for c in docs.columns])
