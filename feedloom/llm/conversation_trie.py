"""The trie of all conversations: one node for each distinct sequence of first turns.

A turn is its role and text, which two 64-bit hashes stand for; texts are never shuffled.
Conversations are range-partitioned by their turns, then by id, so that each shard is a
contiguous piece of the trie. A shard is read in blocks: turn ids become padded matrices, rows are put
in order by ``numpy.lexsort``, changes from row to row are accumulated by OR along the columns and
mark where nodes start, and ``reduceat`` aggregates every depth. A node whose members touch
neither end of its block is finished there. The others lie on the paths of a
block's first and last row: their parts are summed up by a hash of the path, and what a
subtree adds up to is gathered over ancestors at distances 1, 2, 4, ...

The digest of ended conversations of a node that many blocks share is computed from
ordered pieces that stream through one task: a hash chain has no other way. A piece holds ids only,
and the task no more than one at a time.

Defined cases: turns are ordered by ``turn``, NULL first, ties by the hashes of role and text; a NULL role
or text is empty; repeated rows are turns of their own; a NULL conversation id takes no part; other
columns are not looked at; an empty table has no nodes. The ids of one conversation (20 bytes a
turn) must fit in a task; its texts need not.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.plans.staging import stage

#: Cells of a block's matrices: a bound on memory, results do not depend on it.
CELLS = 2_000_000
#: Ids in a piece of a node's ended conversations.
PIECE = 50_000
#: Split nodes are broadcast up to this number, which is counted.
FEW = 20_000
_PAD = np.iinfo(np.int64).min
_NO_ENDS = sha256(b"").hexdigest()
_CLOSED, _OPEN, _ENDS = range(3)
_NODES = (
    "kind int, conv_id long, depth long, key binary, parent_key binary, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, size long, ends string"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` of every conversation: ``hi, lo, size`` of its turns, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The least number is the padding of the matrices.
    hi = F.greatest(F.xxhash64(role, text), F.lit(_PAD + 1))
    lo = F.xxhash64(F.lit("turn"), text, role)
    turn = F.struct("turn", hi.alias("hi"), lo.alias("lo"), F.octet_length(text).cast("long").alias("size"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select("conv_id", _without_number("turns"))


def _without_number(name: str) -> Column:
    return F.transform(name, lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["size"].alias("size"))).alias(name)


def trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conv_id, turns`` rows, with the columns of :data:`RESULT`.

    ``conv_id``: smallest member; ``n_convs``: members; ``n_leaves``: childless nodes below or at the node;
    ``saved_tokens``: bytes of last texts times members but one, summed over the subtree;
    ``ends_sha256``: digest of the ids of members that have no further turn.
    """
    path = F.transform("turns", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo")))
    rows = stage(sequences.select("conv_id", path.alias("path"), F.col("turns.size").alias("size")), "trie-rows")
    shards = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    columns = shards.select("conv_id", F.col("path.hi").alias("hi"), F.col("path.lo").alias("lo"), "size")
    nodes = stage(columns.mapInArrow(_blocks, _NODES), "trie-nodes")
    split = _recombined(nodes.where(F.col("kind") == _OPEN))
    few = split.count() <= FEW

    parents = split.select(F.col("key").alias("_parent"), F.col("conv_id").alias("_parent_conv"))
    parents = F.broadcast(parents) if few else parents
    closed = nodes.where(F.col("kind") == _CLOSED)
    inside = closed.where("parent_key IS NULL").withColumnRenamed("ends", "ends_sha256").select(*RESULT)
    below = closed.where("parent_key IS NOT NULL").join(parents, F.col("parent_key") == F.col("_parent"))
    below = below.withColumn("parent_conv_id", F.col("_parent_conv")).withColumnRenamed("ends", "ends_sha256")

    ends = nodes.where(F.col("kind") == _ENDS).select("key", "conv_id", "ends")
    ends = ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digests, "_ended binary, ends_sha256 string")
    rest = split.join(ends, F.col("key") == F.col("_ended"), "left")
    # The root has no parent: it looks up itself.
    rest = rest.join(parents, F.coalesce("parent_key", "key") == F.col("_parent"))
    rest = rest.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("_parent_conv")))
    rest = rest.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    return inside.unionByName(below.select(*RESULT)).unionByName(rest.select(*RESULT))


def _recombined(parts: DataFrame) -> DataFrame:
    """Nodes that several blocks may hold, each once, with all that their subtrees add up to."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    first = [F.first(c, True).alias(c) for c in ("depth", "parent_key", "size")]
    once = stage(parts.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *first, *sums), "trie-split")
    facts = once.agg(F.count("*"), F.max("depth")).first()
    mark = F.broadcast if facts[0] <= FEW else (lambda df: df)

    children = once.where("parent_key IS NOT NULL").groupBy("parent_key").agg(F.count("*").alias("_more"))
    own = once.join(mark(children.withColumnRenamed("parent_key", "_of")), F.col("key") == F.col("_of"), "left")
    n_children = F.col("n_children") + F.coalesce("_more", F.lit(0))
    own = own.withColumns(
        {
            "n_children": n_children,
            "n_leaves": F.col("n_leaves") + (n_children == 0).cast("long"),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size"),
            "_above": F.col("parent_key"),
        }
    )
    own = stage(own.drop("_of", "_more"), "trie-own")
    # After round k a node holds the sum over descendants less than 2^k away, and knows the ancestor at 2^k.
    for _ in range(int(facts[1] or 0).bit_length()):
        below = own.where("_above IS NOT NULL").groupBy(F.col("_above").alias("_at"))
        below = below.agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        higher = own.select(F.col("key").alias("_via"), F.col("_above").alias("_higher"))
        joined = own.join(mark(below), F.col("key") == F.col("_at"), "left")
        # A node without such an ancestor looks up itself, so that these do not all meet at NULL.
        joined = joined.join(mark(higher), F.coalesce("_above", "key") == F.col("_via"))
        own = joined.select(
            *[c for c in own.columns if c not in ("n_leaves", "saved_tokens", "_above")],
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
            F.when(F.col("_above").isNotNull(), F.col("_higher")).alias("_above"),
        )
        own = stage(own, "trie-own")
    return own.drop("_above")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = np.diff(_list_parts(batch.column(1))[1])
        start, deepest = 0, 1
        for i, length in enumerate(lengths.tolist()):
            if i > start and max(deepest, length) * (i - start + 1) > CELLS:
                yield from _block(batch.slice(start, i - start))
                start, deepest = i, 1
            deepest = max(deepest, length)
        if start < batch.num_rows:
            yield from _block(batch.slice(start))


def _list_parts(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists, and where each list starts and ends in them."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    return values, offsets - offsets[0]


def _block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Nodes of some sequences: those inside the block, and parts of those at its ends."""
    conv = batch.column(0).to_numpy()
    hi_values, offsets = _list_parts(batch.column(1))
    n, length = len(conv), np.diff(offsets)
    deepest = int(length.max())
    row = np.repeat(np.arange(n), length)
    at = np.arange(len(row)) - np.repeat(offsets[:-1], length)
    hi, lo, size = (np.full((n, deepest), fill, np.int64) for fill in (_PAD, _PAD, 0))
    hi[row, at], lo[row, at], size[row, at] = hi_values, _list_parts(batch.column(2))[0], _list_parts(batch.column(3))[0]

    keys = [column for d in range(deepest - 1, -1, -1) for column in (lo[:, d], hi[:, d])]
    order = np.lexsort((conv, *keys))
    conv, length, hi, lo, size = conv[order], length[order], hi[order], lo[order], size[order]
    starts_here = np.ones((n, deepest), bool)
    starts_here[1:] = np.logical_or.accumulate((hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]), axis=1)

    levels = [_level(np.zeros(1, np.int64), np.array([n]), conv, length, 0, np.zeros(1, np.int64))]
    for d in range(1, deepest + 1):
        starts = np.flatnonzero(starts_here[:, d - 1])
        stops = np.append(starts[1:], n)
        real = length[starts] >= d
        levels.append(_level(starts[real], stops[real], conv, length, d, size[starts[real], d - 1]))
    for level in levels:
        level["open"] = (level["start"] == 0) | (level["stop"] == n)
    levels[0]["open"][:] = True
    for above, level in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
        level["parent"] = np.searchsorted(above["start"], level["start"], "right") - 1
        _finish(level)
        inside = ~level["open"]
        np.add.at(above["children"], level["parent"][inside], 1)
        np.add.at(above["leaves"], level["parent"][inside], level["leaves"][inside])
        np.add.at(above["saved"], level["parent"][inside], level["saved"][inside])

    paths = {0: _path(hi[0], lo[0], length[0]), n - 1: _path(hi[-1], lo[-1], length[-1])}
    found: list[tuple] = []
    for d, level in enumerate(levels):
        above = levels[d - 1] if d else None
        inside = np.flatnonzero(~level["open"])
        if len(inside):
            yield _closed(level, above, inside, d, conv, n, paths)
        for i in np.flatnonzero(level["open"]):
            path = paths[0 if level["start"][i] == 0 else n - 1]
            facts = [int(level[c][i]) for c in ("convs", "children", "leaves", "saved", "size")]
            found.append((_OPEN, int(level["least"][i]), d, path[d], path[d - 1] if d else None, None, *facts, None))
            first, ended = int(level["start"][i]), int(level["ended"][i])
            for a in range(first, first + ended, PIECE):
                ids = conv[a : min(a + PIECE, first + ended)].tolist()
                found.append((_ENDS, ids[0], d, path[d], None, None, 0, 0, 0, 0, 0, ",".join(map(str, ids))))
    yield _batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _TYPES, strict=True)])


def _level(starts: np.ndarray, stops: np.ndarray, conv: np.ndarray, length: np.ndarray, depth: int, size: np.ndarray) -> dict:
    """All nodes of one depth: where their members are, and what these add up to."""
    if len(starts):
        # Members of one node lie side by side, those that end there first; rows between nodes are cut off.
        bounds = np.stack([starts, stops], 1).ravel()
        bounds = bounds[:-1] if bounds[-1] == len(conv) else bounds
        least = np.minimum.reduceat(conv, bounds)[::2]
        ended = np.add.reduceat((length == depth).astype(np.int64), bounds)[::2]
    else:
        least = ended = np.zeros(0, np.int64)
    zeros = {name: np.zeros(len(starts), np.int64) for name in ("children", "leaves", "saved", "parent")}
    return {"start": starts, "stop": stops, "convs": stops - starts, "least": least, "ended": ended, "size": size, **zeros}


def _finish(level: dict) -> None:
    """Add what nodes inside the block contribute themselves."""
    inside = ~level["open"]
    level["leaves"] += inside & (level["children"] == 0)
    level["saved"] += np.where(inside, (level["convs"] - 1) * level["size"], 0)


def _path(hi: np.ndarray, lo: np.ndarray, length: int) -> list[bytes]:
    """A hash of each beginning of a sequence, the empty one first."""
    turns = np.stack([hi, lo], 1)[:length].astype("<i8")
    digest = xxhash.xxh3_128()
    found = [digest.digest()]
    for turn in turns:
        digest.update(turn.tobytes())
        found.append(digest.digest())
    return found


def _closed(level: dict, above: dict, inside: np.ndarray, depth: int, conv: np.ndarray, n: int, paths: dict) -> pa.RecordBatch:
    parent = level["parent"][inside]
    split = above["open"][parent]
    keys = [None] * len(inside)
    for i in np.flatnonzero(split):
        keys[i] = paths[0 if above["start"][parent[i]] == 0 else n - 1][depth - 1]
    ends = [_NO_ENDS] * len(inside)
    for i in np.flatnonzero(level["ended"][inside]):
        first = level["start"][inside[i]]
        ids = conv[first : first + level["ended"][inside[i]]].tolist()
        ends[i] = sha256(",".join(map(str, ids)).encode()).hexdigest()
    facts = [level[c][inside] for c in ("convs", "children", "leaves", "saved", "size")]
    columns = [np.full(len(inside), _CLOSED), level["least"][inside], np.full(len(inside), depth), None, keys]
    columns += [pa.array(above["least"][parent], pa.int64(), mask=split), *facts, ends]
    columns[3] = [None] * len(inside)
    return _batch([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, _TYPES, strict=True)])


_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string()]


def _batch(columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in _NODES.split(", ")])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's pieces, which come in order; one piece is held at a time."""
    key, digest = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for k, piece in zip(batch.column(0), batch.column(2), strict=True):
            k, piece = k.as_py(), piece.as_py()
            if k == key:
                digest.update(b",")
            else:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, sha256()
            digest.update(piece.encode())
        if done:
            yield _ended(done)
            done = []
    if digest is not None:
        yield _ended([(key, digest.hexdigest())])


def _ended(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, digests = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["_ended", "ends_sha256"])
