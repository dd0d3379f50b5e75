"""Resample documents towards a target: n-gram importance weights and a Gumbel top-k draw.

Features are runs of words, hashed into buckets by CRC-32. Buckets that the target texts use more
often than the corpus have positive gains; a document's weight is the mean gain of its
features. A draw without replacement takes the highest weights plus Gumbel noise,
which a hash of the document's id decides, so that reruns agree.

Inside a task, the n-grams of a batch are interned in an open-addressed table of numpy
arrays: xxhash64 keys, linear probing, and a comparison of the bytes before two occurrences count as
one n-gram. A slot stores the bucket and the count; occurrences keep their slot, through which they
gather gains. Two passes read the texts: one counts buckets over all documents, one weighs documents.

Ranks come without a task that sees all documents: scores are whole numbers, so a
histogram of them, whose size the range of scores bounds, says which score the last drawn
document has; documents from there up are range-partitioned, and numbered from where their range starts.

Defined cases: a NULL or empty text has no features and weight 0; a NULL id is hashed as no text and comes last
among ties; rows alike in score and id are drawn in any order, each with its own rank; an empty corpus gives
an empty table, an empty target gains by its absence alone. Other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.plans.staging import stage

BUCKETS = 10_000
SEED = 2024
#: Bytes of text that are interned together: a bound on memory, results do not depend on it.
CHUNK = 4_000_000

# Letters, digits, and every byte of a character beyond ASCII.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE, _END = 0x20, 0x00


class Interned:
    """The n-grams of some texts in an open-addressed table.

    ``bucket`` and ``count`` are per slot; ``slot`` and ``doc`` are per occurrence, ``words`` per text.
    """

    def __init__(self, texts: Sequence[str | None], longest: int, buckets: int) -> None:
        joined, self.words, word_starts, word_stops, word_doc = _words(texts)
        starts, stops, docs = [], [], []
        for n in range(1, longest + 1):
            last = np.arange(n - 1, len(word_starts))
            last = last[word_doc[last] == word_doc[last - (n - 1)]]
            starts.append(word_starts[last - (n - 1)])
            stops.append(word_stops[last])
            docs.append(word_doc[last])
        start, stop = np.concatenate(starts), np.concatenate(stops)
        self.doc = np.concatenate(docs)
        digest, data = xxhash.xxh64_intdigest, joined.tobytes()
        keys = np.fromiter(
            (digest(data[i:j]) for i, j in zip(start.tolist(), stop.tolist(), strict=True)), np.uint64, len(start)
        )
        size = 1 << max(4, int(2 * len(start) - 1).bit_length() if len(start) else 4)
        self._owner = np.full(size, -1, np.int64)  # the occurrence whose bytes a slot stands for
        self.slot = self._intern(joined, start, stop, keys)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        used = np.flatnonzero(self._owner >= 0)
        spans = zip(used.tolist(), start[self._owner[used]].tolist(), stop[self._owner[used]].tolist(), strict=True)
        for s, i, j in spans:
            self.bucket[s] = zlib.crc32(data[i:j]) % buckets

    def _intern(self, joined: np.ndarray, start: np.ndarray, stop: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Put every occurrence into its slot: the first free one from its key on, or that of its like."""
        mask = np.uint64(len(self._owner) - 1)
        place = (keys & mask).astype(np.int64)
        slot = np.empty(len(keys), np.int64)
        left = np.arange(len(keys))
        while len(left):
            here = place[left]
            free = self._owner[here] < 0
            # Of several that claim a slot the first gets it: numpy keeps the last one written.
            self._owner[here[free][::-1]] = left[free][::-1]
            owner = self._owner[here]
            alike = keys[owner] == keys[left]
            alike[alike] = _same_bytes(joined, start, stop, owner[alike], left[alike])
            slot[left[alike]] = here[alike]
            left = left[~alike]
            place[left] = (place[left] + 1) & int(mask)
        return slot


def _same_bytes(joined: np.ndarray, start: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether occurrences ``a`` and ``b`` have the same bytes, pair by pair."""
    length = stop[b] - start[b]
    same = (stop[a] - start[a] == length) & (length > 0)
    other = np.flatnonzero(same & (a != b))
    size = length[other]
    if len(other):
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        within = np.arange(size.sum()) - np.repeat(first, size)
        equal = joined[np.repeat(start[a[other]], size) + within] == joined[np.repeat(start[b[other]], size) + within]
        same[other] = np.logical_and.reduceat(equal, first)
    return same


def _words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts with one space between words, words a text, and start, stop and text of every word."""
    lowered = [(t or "").encode().lower() for t in texts]  # bytes: only A-Z change
    raw = np.frombuffer(b"\0".join([*lowered, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    word = _IS_WORD[raw]
    # One separator after each word, a space; the others go. Words of two texts never share a run.
    after = np.zeros(len(raw), bool)
    after[1:] = word[:-1] & ~word[1:]
    keep = word | after
    joined = np.where(word, raw, _SPACE)[keep].astype(np.uint8)
    stops = np.flatnonzero(~word[keep])
    starts = np.concatenate([[0], stops[:-1] + 1])[: len(stops)]
    doc = np.searchsorted(ends, np.flatnonzero(after), "left")
    # A text's last word is followed by the byte that ends the text, which is still its own.
    return joined, np.bincount(doc, minlength=len(texts)), starts, stops, doc


def _chunks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Pieces of the batches of bounded text; a longer text is a piece alone."""
    for batch in batches:
        start, held = 0, 0
        texts = batch.column(at).to_pylist()
        for i, text in enumerate(texts):
            size = len(text or "") + 1
            if i > start and held + size > CHUNK:
                yield batch.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += size
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has any."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for _, piece in _chunks(batches, 0):
            table = Interned(piece, longest, buckets)
            counts += np.bincount(table.bucket, table.count, buckets).astype(np.int64)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["bucket", "n"])

    parts = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds, in thousandths. A number for each bucket reaches the driver."""
    own, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, source in ((own, docs), (wanted, target)):
        for row in bucket_counts(source, text, longest, buckets).collect():
            counts[row["bucket"]] = row["n"]
    all_own, all_wanted = float(own.sum() + buckets), float(wanted.sum() + buckets)
    ratio = [(t + 1.0) * all_own / ((s + 1.0) * all_wanted) for s, t in zip(own.tolist(), wanted.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """Gumbel noise of a document, in thousandths, from a hash of its id."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scores(
    docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = 1, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    buckets = len(gain)

    def run(batches):
        for batch, piece in _chunks(batches, 1):
            table = Interned(piece, longest, buckets)
            gathered = gain[table.bucket][table.slot]
            n = np.bincount(table.doc, minlength=len(piece))
            total = np.bincount(table.doc, gathered, len(piece)).astype(np.int64)  # whole numbers, exact in doubles
            weight = np.floor_divide(total, np.maximum(n, 1))
            score = weight + np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (table.words, n, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... by falling score among the documents drawn, else NULL.

    ``scored`` must be a written table. Drawn are so many percent of the documents of at
    least ``least_words``, rounded down.
    """
    fit = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    # One number for each score there is; scores are logarithms in thousandths, a bounded range.
    histogram = sorted(((r["score"], r["count"]) for r in scored.where(fit).groupBy("score").count().collect()), reverse=True)
    wanted = percent * sum(n for _, n in histogram) // 100
    last, so_far = None, 0
    for score, n in histogram:
        if so_far >= wanted:
            break
        last, so_far = score, so_far + n
    no_rank = F.lit(None).cast("long")
    if last is None:
        return scored.withColumn("rank", no_rank)
    near = fit & (F.col("score") >= last)
    ranked = _numbered(scored.where(near), [F.desc("score"), F.asc_nulls_last("doc_id")])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return scored.where(~near).withColumn("rank", no_rank).unionByName(ranked)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, ... in ``order``, over ranges that equal rows may be spread over."""
    # Rows alike in the order are dealt by a number of their own, or one range would get them all.
    dealt = rows.withColumn("_deal", F.monotonically_increasing_id()).repartitionByRange(*order, "_deal")
    ranges = stage(dealt.withColumn("_range", F.spark_partition_id()), "draw-ranges")
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_rows"))
    # One line for each range.
    before = F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")
    offsets = counts.select(F.col("_range").alias("_of"), before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_deal"))
    numbered = ranges.withColumn("_place", place).join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
    return numbered.withColumn("rank", F.col("_before") + F.col("_place")).select(*rows.columns, "rank")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = SEED,
) -> DataFrame:
    """Every document's ``doc_id, n_words, n_features, weight, score`` and, if it is drawn, ``rank``."""
    gain = gains(docs, target, text, longest, buckets)
    scored = stage(scores(docs, gain, doc_id, text, longest, seed), "resampling-scores")
    return draw(scored, percent, least_words)
