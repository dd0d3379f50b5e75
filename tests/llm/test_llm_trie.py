"""The trie of conversations against one built from prefixes in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import pyarrow as pa
import pytest

from feedloom.llm import conversation_trie
from feedloom.llm.conversation_trie import RESULT, sequences, trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, size string, depth int, ends string"


def _expected(turns):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in turns:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    paths = {c: tuple(t for _, t in sorted(rows, key=lambda r: r[0])) for c, rows in convs.items()}
    return _nodes(paths)


def _nodes(paths):
    members, ended = defaultdict(list), defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
        ended[path].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def leaves(node):
        return sum(map(leaves, children[node])) if children[node] else 1

    def saved(node):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        return own + sum(map(saved, children[node]))

    out = []
    for node, found in members.items():
        digest = sha256(",".join(map(str, sorted(ended[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(found), len(node), parent, len(found), len(children[node]), leaves(node), saved(node), digest))
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.select(*RESULT).collect()), key=repr)


def _conversations(n, seed):
    """Few different turns, so that much is shared; some conversations alike, some long."""
    rng = random.Random(seed)
    rows = []
    for conv in range(-3, n):
        length = rng.choice([1, 2, 3, 4, 6, 40])
        kind = rng.random()
        for turn in range(length):
            text = "same" if kind < 0.4 else rng.choice(["a", "b", "ß", ""])
            rows.append((conv, turn, rng.choice(["user", "bot"]) if kind > 0.9 else "user", text, "k", "s", 1, "e"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_nodes_equal_prefixes(spark, coalesce):
    """In one shard, and in many that share hot nodes."""
    rows = _conversations(120, 5)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, coalesce)
    try:
        found = _found(trie(sequences(spark.createDataFrame(rows, SCHEMA))))
    finally:
        spark.conf.set(name, before)
    assert found == _expected(rows)


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None, None, None, None, None),
        (1, 0, "user", "x", None, None, None, None),
        (2, None, "", "", None, None, None, None),
        (2, 5, "user", "x", None, None, None, None),
        (3, 1, "user", None, None, None, None, None),
        (3, 1, "user", None, None, None, None, None),
        (None, 1, "user", "lost", None, None, None, None),
        (4, 0, "user", "long " * 50_000, None, None, None, None),
    ]
    assert _found(trie(sequences(spark.createDataFrame(rows, SCHEMA)))) == _expected(rows)
    assert _found(trie(sequences(spark.createDataFrame([], SCHEMA)))) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    rows = spark.createDataFrame(
        [(7, []), (8, [(1, 2, 3)]), (9, [])], "conv_id long, turns array<struct<hi: long, lo: long, size: long>>"
    )
    digest = sha256(b"7,9").hexdigest()
    assert (7, 0, None, 3, 1, 1, 0, digest) in _found(trie(rows))


def test_blocks_are_bounded(monkeypatch):
    """However few cells a block may have, all members are in some block's part of the root."""
    monkeypatch.setattr(conversation_trie, "CELLS", 12)
    path = [[1, 2, 3], [1, 2], [1], [4] * 30, [], [5]]
    arrays = [pa.array(range(6), pa.int64()), *[pa.array(path, pa.list_(pa.int64()))] * 3]
    batch = pa.RecordBatch.from_arrays(arrays, names=["conv_id", "hi", "lo", "size"])
    parts = pa.Table.from_batches(conversation_trie._blocks([batch])).to_pylist()
    roots = [p for p in parts if p["depth"] == 0 and p["kind"] == 1]
    assert len(roots) > 2 and sum(p["n_convs"] for p in roots) == 6


def test_digests_stream_over_pieces():
    pieces = [(b"a", 1, "1,2"), (b"a", 3, "3"), (b"b", 9, "9")]
    arrays = [pa.array(c) for c in zip(*pieces, strict=True)]
    batches = [pa.RecordBatch.from_arrays(arrays, names=["key", "conv_id", "ends"]).slice(i, 1) for i in range(3)]
    found = pa.Table.from_batches(conversation_trie._digests(batches)).to_pylist()
    assert [(r["_ended"], r["ends_sha256"]) for r in found] == [
        (b"a", sha256(b"1,2,3").hexdigest()),
        (b"b", sha256(b"9").hexdigest()),
    ]
