"""Document fingerprints that add up: a homomorphic hash of the multiset of paragraphs.

A paragraph is hashed to a wide vector of 32-bit numbers. The fingerprint of a document is
the sum of its paragraphs' vectors modulo 2^32, so the order of paragraphs does not matter, and
a paragraph is inserted or deleted by adding or subtracting its vector. A second block of
the fingerprint is summed the same way over the sentences of the paragraphs from vectors of
+1 and -1, also modulo 2^32, so that a text of up to 2^31 sentences is told apart from any other. The squared length of a difference of two such sums estimates
how many sentences two documents do not share, which makes fingerprints comparable as well.

Defined cases: NULL counts as an empty text, whose fingerprint is all zeros; blank lines are
no paragraphs; the likeness of two fingerprints of zeros is 1, of one with another 0; equal
texts have equal fingerprints; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedloom.plans.staging import stage

WIDE, SKETCH = 64, 256
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_NULL = 2**63 - 1


def paragraphs(text: str) -> list[str]:
    return [line for line in text.split("\n") if line and not line.isspace()]


def _wide(lines: list[str]) -> np.ndarray:
    data = b"".join([hashlib.shake_128(line.encode()).digest(4 * WIDE) for line in lines])
    return np.frombuffer(data, "<u4").reshape(-1, WIDE).sum(0, dtype=np.uint32)


def _signs(lines: list[str]) -> np.ndarray:
    sentences = [s for line in lines for s in _SENTENCE.split(line.strip())]
    data = b"".join([hashlib.blake2b(s.encode(), digest_size=SKETCH // 8).digest() for s in sentences])
    ones = np.unpackbits(np.frombuffer(data, np.uint8).reshape(-1, SKETCH // 8), axis=1).sum(0, dtype=np.int64)
    return (2 * ones - len(sentences)).astype(np.uint32)


def total(lines: list[str]) -> np.ndarray:
    """The sum of the vectors of paragraphs."""
    if not lines:
        return np.zeros(WIDE + SKETCH, np.uint32)
    return np.concatenate([_wide(lines), _signs(lines)])


def fingerprint(text: str | None) -> np.ndarray:
    return total(paragraphs(text or ""))


def changed(found: np.ndarray, deleted: list[str], inserted: list[str]) -> np.ndarray:
    """The fingerprint after some paragraphs left and others came."""
    return found - total(deleted) + total(inserted)


def written(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: the share of sentences that two documents have in common, as estimated."""
    if np.array_equal(a, b):
        return 1.0
    x, y, d = ((v[WIDE:]).astype(np.int32).astype(float) for v in (a, b, a - b))
    size = x @ x + y @ y
    return float(min(1.0, max(0.0, 1 - d @ d / size))) if size else 0.0


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last quarter replaced by the start of another, and where its changed paragraphs begin."""
    cut = len(text) - len(text) // 4
    return text[:cut] + following[: len(text) // 4], text.rfind("\n", 0, cut) + 1


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fingerprint`` of every whole text. One pass without a shuffle."""
    rows = docs.select(*keep, F.col(text).alias("_hash_text"))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            found = [written(fingerprint(t.as_py())) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=schema.names)

    return rows.mapInArrow(run, schema)


def with_following(docs: DataFrame, doc_id: str, text: str, rows_per_bucket: int = 256, most_buckets: int = 20_000) -> DataFrame:
    """``bucket, guest, key, body, doc_id, text``: ranges of ids, each with the first row of the next range.

    Rows are in order of id, NULL last, and then of a hash of the text, compared as whole numbers, so
    that an id of very many rows spreads over ranges. A range starts at every so many rows of that
    order; the starts, ``most_buckets`` and one a task at most, reach the driver without texts. Texts are
    shuffled once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("key"), F.xxhash64("text").alias("body"), "doc_id", "text"
    )
    keys = stage(rows.select(F.col("doc_id").isNull().alias("none"), "key", "body"), "hash-keys")
    starts = _starts(keys, rows_per_bucket, most_buckets)
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("guest", T.IntegerType()), *rows.schema])

    def deal(batches):
        for batch in batches:
            keys, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            order = list(zip(batch.column(2).is_null().to_pylist(), keys, bodies, strict=True))
            buckets = [bisect_right(starts, row) - 1 for row in order]
            yield _dealt(batch, buckets, 0, schema)
            # The first row of a range also goes to the range before; that of the first one to the last.
            first = [i for i, row in enumerate(order) if starts[buckets[i]] == row]
            if first:
                yield _dealt(batch.take(pa.array(first)), [(buckets[i] - 1) % len(starts) for i in first], 1, schema)

    dealt = rows.mapInArrow(deal, schema).repartition("bucket")
    return dealt.sortWithinPartitions("bucket", "guest", F.col("doc_id").isNull(), "key", "body", "text")


def _starts(keys: DataFrame, rows_per_bucket: int, most_buckets: int) -> list[tuple[bool, int, int]]:
    """The first row ``none, key, body`` of each range, in order."""
    count = keys.count()
    step = max(rows_per_bucket, -(-count // most_buckets))
    tasks = max(1, min(count // step, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    order = ["none", "key", "body"]

    def run(batches):
        at, last = 0, None
        for batch in batches:
            found = []
            for i in range(-at % step, batch.num_rows, step):
                row = tuple(c[i].as_py() for c in batch.columns)
                if row != last:
                    found.append(row)
                    last = row
            at += batch.num_rows
            yield pa.RecordBatch.from_pylist([dict(zip(order, row, strict=True)) for row in found], schema=batch.schema)

    spread = keys.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    found = spread.mapInArrow(run, keys.schema).toArrow()
    return sorted(zip(*(found[c].to_pylist() for c in order), strict=True))


def _dealt(batch: pa.RecordBatch, buckets: list[int], guest: int, schema: T.StructType) -> pa.RecordBatch:
    columns = [pa.array(buckets, pa.int32()), pa.array([guest] * len(buckets), pa.int32()), *batch.columns]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document, by ascending id.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The
    edited fingerprint comes from the document's own by deletion and insertion.
    """
    rows = with_following(docs, doc_id, text)
    fields = [
        rows.schema["doc_id"],
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")),
    ]
    schema = T.StructType(fields)

    def compared(one, other):
        (own_id, own_text, own), (_, other_text, following) = one, other
        new, start = edited(own_text, other_text)
        new_print = changed(own, paragraphs(own_text[start:]), paragraphs(new[start:]))
        return (
            own_id, len(own_text), hashlib.sha256(new.encode()).hexdigest(), written(own), written(new_print),
            likeness(own, new_print), likeness(own, following),
        )

    def run(batches):
        bucket, last, closed = None, None, False
        for batch in batches:
            found = []
            for at, guest, row_id, row_text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4), batch.column(5), strict=True
            ):
                if at != bucket:
                    bucket, last, closed = at, None, False
                if closed or (guest and last is None):
                    continue
                row_text = row_text.as_py()
                row = (row_id.as_py(), row_text, fingerprint(row_text))
                if last is not None:
                    found.append(compared(last, row))
                last, closed = row, bool(guest)
                if len(found) >= 500:
                    yield _batch(found, schema)
                    found = []
            yield _batch(found, schema)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    types = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)
