"""Near-duplicates by HyperMinHash: banded compressed registers, corrected estimates, exact verification.

A text's set of word shingles is hashed into buckets. Of each bucket's least hash a register
keeps the number of leading zeros and ten mantissa bits after the first one: 16 bits. Registers in bands are
candidates' keys; an empty bucket borrows from the first full one in an order of its own, so that small sets
agree as often as their similarity says. Candidates whose similarity, estimated
from registers and corrected for chance collisions, lies six standard deviations below the
threshold go; all others are compared on their full sets of 64-bit shingle hashes.

Equal sets are brought together first, whatever their number. In a bucket of a band each set is compared
with the bucket's leader, the member whose bands are the most crowded: the centre of a crowd of near copies. The
links found make components. Only sets that share a bucket, whose leader they are not, with such a set of another
component go on: each set's rarest shingles, enough that two sets at the threshold share one, lead to partners of other
components, from the side that is not the largest component there, and only to sizes and places that
can still reach the threshold if all rarer shingles differ. So a crowd is not compared pair by pair, and
no pair is left out. Groups are connected components of all links.

A pair at the threshold of 0.8 shares no band with a probability of 1 in 8 million (40 bands of five
registers), one at 0.85 with 1 in 10 billion.

Defined cases: only A-Z are lowered, ASCII white space separates words; fewer words than a shingle are one shingle;
a text without words, or NULL, has an empty set and is linked with nothing; rows alike get results alike; a NULL
id counts for no group's smallest id, and is never kept; an empty table gives an empty table. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.components import components
from feedloom.plans.staging import stage

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Similarity in hundredths.
THRESHOLD = 80
SEED = 42
#: Standard deviations an estimate may lie below the threshold.
SPREAD = 6
_MOST_ZEROS = 62
#: Words whose hashes a task remembers.
_WORDS = 200_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
#: For each bucket, the order in which it borrows from the others; the bucket itself first.
_ORDER = np.argsort(np.random.default_rng(SEED).random((REGISTERS, REGISTERS)) + 1 - 2 * np.eye(REGISTERS), axis=1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int, known: dict[bytes, int]) -> np.ndarray:
    """Hashes of the distinct shingles of a whole text, ascending; ``known`` keeps hashes of words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((known.get(w) or known.setdefault(w, digest(w, SEED)) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total * _ODD[0] + hashes[i : i + len(total)])
    return np.unique(total)


def registers(hashes: np.ndarray) -> np.ndarray:
    """A register for each bucket of a set: 0 if empty, else 1 + zeros * 2^10 + mantissa, falling with the least hash."""
    found = np.zeros(REGISTERS, np.int64)
    if not len(hashes):
        return found
    bucket = ((hashes >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    value = _mixed(hashes + _ODD[0])
    least = np.full(REGISTERS, 2**64 - 1, np.uint64)
    np.minimum.at(least, bucket.astype(np.int64), value)
    full = np.zeros(REGISTERS, bool)
    full[bucket.astype(np.int64)] = True
    least = np.maximum(least, np.uint64(1 << MANTISSA))
    # The exponent of a double may round up near a power of two; taken from whole numbers instead.
    top = np.zeros(REGISTERS, np.int64)
    rest = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        large = rest >= np.uint64(1 << step)
        top[large] += step
        rest[large] >>= np.uint64(step)
    zeros = np.minimum(63 - top, _MOST_ZEROS)
    after = (least >> (top - MANTISSA).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    found[full] = (1 + (zeros << MANTISSA) + ((1 << MANTISSA) - 1 - after.astype(np.int64)))[full]
    return found


def bands(found: np.ndarray) -> np.ndarray:
    """A number for each band; an empty bucket stands for the full one it borrows from."""
    source = np.arange(REGISTERS)
    empty = np.flatnonzero(found == 0)
    if len(empty):
        source[empty] = _ORDER[empty, (found[_ORDER[empty]] > 0).argmax(1)]
    parts = ((source << 16) | found[source]).astype(np.uint64).reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = _mixed(keys * _ODD[0] + parts[:, r])
    return keys.view(np.int64)


@lru_cache(1 << 16)
def _chance(n: int, m: int) -> float:
    """How often two unrelated sets of sizes ``n`` and ``m`` agree in a register."""
    zeros = np.arange(_MOST_ZEROS + 1)
    low, high = 0.5 ** (zeros + 1) / REGISTERS, 0.5**zeros / REGISTERS
    inside = [(1 - low) ** size - (1 - high) ** size for size in (n, m)]
    return float((inside[0] * inside[1]).sum() / 2**MANTISSA)


def may_reach(a: np.ndarray, b: np.ndarray, n: int, m: int, threshold: int = THRESHOLD) -> bool:
    """Whether two sets' estimated similarity leaves room for the threshold."""
    either = int(((a > 0) | (b > 0)).sum())
    agree = int(((a > 0) & (a == b)).sum())
    # Sizes are rounded to powers of 1.1, so that few pairs of sizes have their chances worked out.
    step = [round(1.1 ** round(np.log(s) / np.log(1.1))) for s in (n, m)]
    t = threshold / 100
    estimate = (agree - _chance(*step) * REGISTERS) / max(either, 1)
    return estimate >= t - SPREAD * np.sqrt(t * (1 - t) / max(either, 1))


_SETS = "doc_id {kind}, body binary, n long, digest binary, registers binary, keys array<long>"


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 2) -> DataFrame:
    """``doc_id, body, n, digest, registers, keys`` of every document: a digest of its text, the size of its set,
    the set's digest, and its registers and bands."""
    body = F.unhex(F.md5(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            if len(known) > _WORDS:
                known.clear()
            sizes, ids, stored, keys = [], [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), width, known)
                sizes.append(len(found))
                if len(found):
                    own = registers(found)
                    ids.append(xxhash.xxh3_128_digest(found.astype("<u8").tobytes()))
                    stored.append(own.astype("<u2").tobytes())
                    keys.append(bands(own))
                else:
                    ids.append(None)
                    stored.append(None)
                    keys.append(None)
            columns = [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(stored, pa.binary())]
            columns += [pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["doc_id", "body", "n", "digest", "registers", "keys"])

    return rows.mapInArrow(run, _SETS.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def _estimated(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those of the pairs ``a, b`` of set ids whose registers leave room for a link."""
    both = pairs
    for side in ("a", "b"):
        own = [F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"registers_{side}")]
        both = both.join(sets.select(*own), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            yield _filtered(batch, [may_reach(np.frombuffer(x, "<u2"), np.frombuffer(y, "<u2"), n, m, threshold) for x, y, n, m in rows])

    return both.select("a", "b", "registers_a", "registers_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def _filtered(batch: pa.RecordBatch, good: list[bool]) -> pa.RecordBatch:
    kept = pa.array(good, pa.bool_())
    return pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], names=["a", "b"])


def _verified(pairs: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """Those of the pairs whose full sets are similar enough; ``full`` has ``id, hashes``."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(full.select(F.col("id").alias(side), F.col("hashes").alias(f"hashes_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True)
            yield _filtered(batch, [alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), threshold) for x, y in rows])

    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(run, "a long, b long")


def alike(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether the similarity of two ascending sets reaches the threshold."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= threshold * (len(a) + len(b) - common)


def _full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``id, hashes`` of the wanted sets, each from one document of it; ``wanted`` has ``id, one``. Reads the texts again."""
    of = wanted.select("id", F.col("one.doc_id").alias("_of"), F.col("one.body").alias("_body"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(text)).alias("body"), F.col(text).alias("text"))
    found = own.join(of, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("body") == F.col("_body"))).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            if len(known) > _WORDS:
                known.clear()
            hashes = [shingles(t.as_py(), width, known).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], names=["id", "hashes"])

    return found.mapInArrow(run, "id long, hashes binary").dropDuplicates(["id"])


def _shared(distinct: DataFrame) -> DataFrame:
    """``key, id, crowd``: bands that several sets share, and by how many each is shared."""
    members = distinct.select(F.explode("keys").alias("key"), "id")
    crowds = members.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
    return members.join(stage(crowds, "hmh-crowds"), "key")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _beside_leaders(members: DataFrame) -> DataFrame:
    """``key, id, leader``: the members of each band but its leader, and that."""
    scores = members.groupBy("id").agg(F.sum("crowd").alias("score"))
    scored = members.join(stage(scores, "hmh-scores"), "id")
    leaders = scored.groupBy("key").agg(F.max(F.struct("score", "id")).alias("leader"))
    leaders = stage(leaders.select("key", F.col("leader.id").alias("leader")), "hmh-leaders")
    return members.select("key", "id").join(leaders, "key").where("id <> leader")


def _bin(n: Column) -> Column:
    """Sizes in steps of about two percent."""
    return F.floor(F.log2(n) * 32).cast("long")


def _across(tokens: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: pairs of different components that can reach the threshold, by their rarest shingles.

    ``tokens`` has ``id, token``, ``sets`` has ``id, n, root``. Each set's tokens are put in one order, the
    rarest first. If the first token that two sets share has ``rest`` tokens from it on in each, they share no
    more than the lesser rest; a pair is found at that token if this is enough. Tokens of one set only come before
    all others, and nobody shares them.
    """
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    tokens = tokens.join(stage(often, "hmh-often"), "token")
    place = F.row_number().over(Window.partitionBy("id").orderBy("often", "token"))
    behind = F.count("*").over(Window.partitionBy("id")) - place + 1
    ranked = tokens.withColumn("rest", behind).join(sets, "id")
    least = -F.floor(-F.col("n") * threshold / 100)
    first = stage(ranked.where(F.col("rest") >= least).select("token", "id", "n", "rest", "root"), "hmh-first")

    by_root = first.groupBy("token", "root").agg(F.count("*").alias("rows"))
    largest = by_root.groupBy("token").agg(F.max(F.struct("rows", "root")).alias("top"), F.count("*").alias("roots"))
    largest = stage(largest.where("roots > 1").select("token", F.col("top.root").alias("top")), "hmh-mixed")
    mixed = stage(first.join(largest, "token"), "hmh-first-mixed")
    indexed = mixed.select("token", _bin(F.col("n")).alias("bin"), *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "rest", "root")])
    # The partner has at least the threshold's share of n, and at most what the rest of n's shingles allow.
    most = F.floor((100 + threshold) * F.col("rest") / threshold) - F.col("n")
    asks = mixed.where((F.col("root") != F.col("top")) & (most >= least))
    bins = F.explode(F.sequence(_bin(least), _bin(most))).alias("bin")
    asks = asks.select("token", bins, *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "rest", "root")])
    both = F.least("rest_a", "rest_b") * (100 + threshold) >= threshold * (F.col("n_a") + F.col("n_b"))
    found = asks.join(indexed, ["token", "bin"]).where((F.col("root_a") != F.col("root_b")) & both)
    return found.select(*_pair("id_a", "id_b")).distinct()


def links(docs: DataFrame, distinct: DataFrame, doc_id: str, text: str, width: int, threshold: int) -> DataFrame:
    """``a, b``: links between different sets whose connected components are those of all links.

    ``distinct`` has ``id, one, n, registers, keys`` of every set that is not empty.
    """
    members = stage(_shared(distinct), "hmh-members")
    sets = distinct.select("id", "one", "n", "registers").join(members.select("id").distinct(), "id")
    sets = stage(sets, "hmh-sets")
    beside = stage(_beside_leaders(members), "hmh-beside")
    near = stage(_estimated(beside.select(*_pair("id", "leader")).distinct(), sets, threshold), "hmh-near")
    full = stage(_full_sets(docs, sets.select("id", "one"), doc_id, text, width), "hmh-full")
    found = stage(_verified(near, full, threshold), "hmh-links")

    # A leader has been compared with its whole band: what is left to compare are the others of a band.
    roots = stage(components(found, "a", "b"), "hmh-roots")
    rooted = beside.join(roots, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    rooted = stage(rooted, "hmh-rooted")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    left = stage(rooted.join(stage(mixed.select("key"), "hmh-mixed-keys"), "key").select("id", "root").distinct(), "hmh-left")
    left = stage(left.join(sets, "id").select("id", "n", "root"), "hmh-left-sets")
    tokens = full.join(left.select("id"), "id").mapInArrow(_tokens, "id long, token long")
    across = _across(tokens, left, threshold)
    rest = stage(_estimated(stage(across, "hmh-across"), sets, threshold), "hmh-rest")
    return found.unionByName(_verified(rest, full, threshold))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for id, hashes in zip(batch.column(0), batch.column(1), strict=True):
            found = np.frombuffer(hashes.as_py(), "<u8").view(np.int64)
            ids = np.full(len(found), id.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found)], names=["id", "token"])


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 2, threshold: int = THRESHOLD
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document: its set's size, the smallest id it is linked
    with, directly or by others, and whether that is its own."""
    rows = stage(signatures(docs, doc_id, text, width), "hmh-rows")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), "body"))
    first = [F.first(c).alias(c) for c in ("n", "registers", "keys")]
    distinct = rows.where("digest IS NOT NULL").groupBy("digest").agg(smallest.alias("one"), *first)
    # Numbered as they are written down: eight bytes for each place a set is named.
    distinct = stage(distinct.withColumn("id", F.monotonically_increasing_id()), "hmh-distinct")
    roots = components(links(docs, distinct, doc_id, text, width, threshold), "a", "b")
    known = distinct.select("id", "digest", F.col("one.doc_id").alias("smallest"))
    known = known.join(roots, F.col("id") == F.col("node"), "left")
    known = stage(known.select("digest", "smallest", F.coalesce("root", "id").alias("root")), "hmh-known")
    least = stage(known.groupBy("root").agg(F.min("smallest").alias("component_id")), "hmh-least")
    classes = stage(known.join(least, "root").select("digest", "component_id"), "hmh-classes")
    linked = rows.where("digest IS NOT NULL").select("doc_id", "n", "digest").join(classes, "digest")
    alone = rows.where("digest IS NULL").withColumn("component_id", F.col("doc_id"))
    every = linked.select("doc_id", "n", "component_id").unionByName(alone.select("doc_id", "n", "component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
