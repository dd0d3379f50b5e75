"""The key index of a table and the tiers of its batches."""

from __future__ import annotations

import random
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from test_tables import ODD, feedback, ids

from feedloom.operators import hashed, tables
from feedloom.operators.hashed import HashedRows
from feedloom.operators.key_index import KeyIndex
from feedloom.plans.staging import fresh_path, stage
from feedloom.streaming.upsert import upsert


@pytest.fixture
def bronze(spark):
    name = f"test_{uuid4().hex}"
    tables.use_database(spark, name, fresh_path(spark, name))
    return f"{name}.bronze"


def index_of(spark, table, keys=("content_id",)):
    return KeyIndex(spark, table, tables.location(spark, table), keys)


def some(spark, first, n, game="g"):
    return feedback(spark, [(str(i), game, "text", "2024-01-01") for i in range(first, first + n)])


def test_runs_are_merged_by_size(spark, monkeypatch):
    monkeypatch.setattr(hashed, "FAN", 3)
    monkeypatch.setattr(hashed, "LEAST", 1)
    schema = spark.range(1).schema
    rows = HashedRows(spark, fresh_path(spark, "hashed"), schema, ["id"])
    written = 0
    for version in range(1, 28):
        before = {r.path for r in rows.runs()}
        rows.add(spark.range(1000 * version, 1000 * version + 1000).coalesce(1), version)
        written += sum(spark.read.parquet(r.path).count() for r in rows.runs() if r.path not in before)
    assert len(rows.runs()) <= 7
    assert sorted(r.id for r in rows.candidates(spark.range(1)).collect()) == list(range(1000, 28_000))
    assert written <= 27_000 * 4  # each row once for every size, not once for every later run


def test_only_possible_buckets_are_read(spark, monkeypatch):
    """As a table grows, a merge of few keys reads no more files than these keys have buckets."""
    monkeypatch.setattr(hashed, "PER_BUCKET", 400)
    monkeypatch.setattr(hashed, "PER_TASK", 20)
    schema = spark.range(1).schema
    rows = HashedRows(spark, fresh_path(spark, "hashed"), schema, ["id"])
    asked = stage(spark.createDataFrame([(5,), (7,), (10**9,)], "id long"), "asked")
    read = []
    for version in (1, 2, 3):
        rows.add(spark.range(0, 2000 * version).where(f"id >= {2000 * (version - 1)}"), version)
        found = rows.candidates(asked)
        assert {5, 7} <= {r.id for r in found.collect()}
        read.append(len(found.inputFiles()))
    buckets = sum(r.buckets for r in rows.runs())
    assert buckets >= 3 * 20 and max(read) <= 4 and read[-1] <= read[0] + 1
    # Not one of many unknown keys leads to many buckets, however many tasks test them.
    unknown = stage(spark.range(10**6, 10**6 + 300), "asked")
    assert len(unknown.collect()) == 300
    nothing = rows.candidates(unknown)
    assert nothing is None or len(nothing.inputFiles()) <= 12


def test_keys_with_nulls_and_several_columns(spark, monkeypatch):
    monkeypatch.setattr(hashed, "PER_BUCKET", 100)
    made = [(None, None), ("a", None), (None, "a"), *[(str(i), "b") for i in range(40)]]
    data = spark.createDataFrame(made, "x string, y string")
    rows = HashedRows(spark, fresh_path(spark, "hashed"), data.schema, ["x", "y"])
    rows.add(data, 1)
    asked = stage(data.limit(3), "asked")
    assert {(r.x, r.y) for r in asked.collect()} <= {(r.x, r.y) for r in rows.candidates(asked).collect()}


def test_an_index_follows_upserts_and_deletes(spark, bronze, monkeypatch):
    monkeypatch.setattr(hashed, "FAN", 2)
    monkeypatch.setattr(hashed, "PER_BUCKET", 1000)
    upsert(some(spark, 0, 10), bronze)
    upsert(some(spark, 5, 10, ODD), bronze)
    assert ids(spark, bronze) == sorted(map(str, range(15)))
    tables.delete_game(spark, [bronze], ODD)
    assert ids(spark, bronze) == sorted(map(str, range(10)))
    upsert(some(spark, 8, 4, ODD), bronze)  # the deleted ones may come again, the others not
    assert ids(spark, bronze) == sorted(map(str, range(12)))
    upsert(some(spark, 0, 12, "h"), bronze)
    assert spark.table(bronze).where("game_name = 'h'").isEmpty()
    upsert(some(spark, 50, 1, None), bronze)
    tables.delete_game(spark, [bronze], "g")
    upsert(some(spark, 0, 3), bronze)
    assert ids(spark, bronze) == sorted(["0", "1", "2", "10", "11", "50"])


def test_a_crash_between_table_and_index(spark, bronze, monkeypatch):
    upsert(some(spark, 0, 3), bronze)
    monkeypatch.setattr(KeyIndex, "settle", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        upsert(some(spark, 2, 4), bronze)
    monkeypatch.undo()
    upsert(some(spark, 0, 8), bronze)
    assert ids(spark, bronze) == sorted(map(str, range(8)))


def test_a_table_without_index_gets_one(spark, bronze):
    tables.create_item_table(spark, bronze, "content_id string, content_text string")
    rows = spark.createDataFrame([("1", "x", "g"), ("2", "y", None)], "content_id string, content_text string, game_name string")
    tables.write_batch(rows, bronze, "first")
    known = index_of(spark, bronze).known(stage(rows, "asked"))
    assert sorted(r["_known_content_id"] for r in known.collect()) == ["1", "2"]
    assert index_of(spark, bronze).known(stage(rows, "asked"), but="first").isEmpty()


def test_rows_are_written_again_logarithmically_often():
    """500 batches of odd sizes: what is merged, when, and how often a byte is written."""
    rng = random.Random(1)
    for limit in (10, 40, 100):
        sizes, written, total = {}, 0, 0
        for n in range(500):
            sizes[f"b{n}"] = rng.choice([1, 1, 1, 5, 200])
            total += sizes[f"b{n}"]
            old = tables.to_merge(sizes, limit)
            if old:
                merged = sum(sizes.pop(name) for name in old)
                assert all(size > merged for size in sizes.values())
                sizes[f"m{n}"] = merged
                written += merged
            assert len(sizes) <= limit and sum(sizes.values()) == total
        assert written <= 9 * total
    assert tables.to_merge({"a": 1}, 1) == [] and tables.to_merge({"a": 1}, 0) == ["a"] and tables.to_merge({"a": 1, "b": 9}, 0) == ["a", "b"]


def test_the_largest_batch_stays(spark, bronze):
    upsert(some(spark, 0, 3000), bronze)
    for n in range(4):
        upsert(some(spark, 10_000 + n, 1), bronze)
    first = {r.batch_id for r in spark.table(bronze).where("content_id = '5'").select("batch_id").collect()}
    assert len(tables.compact(spark, bronze, 3)) == 4
    assert first <= {r.batch_id for r in spark.table(bronze).select("batch_id").collect()}
    assert spark.table(bronze).select("batch_id").distinct().count() == 2
    assert spark.table(bronze).agg(F.count_distinct("content_id")).first()[0] == 3004
    upsert(some(spark, 0, 3000), bronze)
    upsert(some(spark, 10_000, 4), bronze)
    assert spark.table(bronze).count() == 3004
