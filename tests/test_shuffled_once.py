"""Texts are shuffled and written no more often than the result needs."""

from __future__ import annotations

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from checks import views
from feedloom.functions.rows import is_row_by_row, row_by_row
from feedloom.operators import merge, tables
from feedloom.plans.staging import fresh_path
from feedloom.streaming import chain as streams
from feedloom.streaming.upsert import upsert

SF = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark):
    name = f"once_{uuid4().hex}"
    tables.use_database(spark, name, fresh_path(spark, name))
    return name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_wide_steps_are_spread(spark, database, monkeypatch):
    spread = {}
    write = tables.write_batch

    def seen(rows, table, batch_id, **options):
        spread.setdefault(table.split(".")[-1].strip("`"), []).append(options.get("spread", True))
        write(rows, table, batch_id, **options)

    monkeypatch.setattr(streams, "write_batch", seen)
    wide = lambda df: views.translate_none(df).repartition(3)
    checkpoints = fresh_path(spark, "once-checkpoints")
    chain = streams.Chain(database, checkpoints, translate=wide, extract=views.answer)
    upsert(views.feedback(spark, SF), chain.table(streams.BRONZE))
    streams.refresh(spark, chain)
    assert spread == {
        streams.TRANSLATED: [True],
        **{name: [False] for name in (streams.EXTRACTED, streams.PARSED, streams.ITEMS, streams.TOPICS)},
    }
    for name in (streams.EXTRACTED, streams.PARSED, streams.ITEMS):
        files = spark.table(chain.table(name)).inputFiles()
        assert len(files) <= len(spark.table(chain.table(streams.TRANSLATED)).inputFiles())
        assert all(file.endswith(".zstd.parquet") for file in files)


def test_marks_are_seen_through_partial_functions():
    from functools import partial

    assert is_row_by_row(partial(row_by_row(lambda df, n: df), n=1))
    assert not is_row_by_row(lambda df: df)


@pytest.mark.parametrize("broadcast", [0, 1, 100])
def test_newest_staged_is_newest_copy(spark, monkeypatch, broadcast):
    monkeypatch.setattr(merge, "BROADCAST_KEYS", broadcast)
    rows = [("1", "g", "2024-01-01"), ("1", "g", "2024-02-01"), ("2", None, "2024-01-01"), ("2", None, "2024-01-02"), (None, "g", None), ("3", "g", "2024-01-01")]
    made = spark.createDataFrame(rows, "content_id string, game_name string, timestamp string")
    made = made.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for keys in (["content_id"], ["content_id", "game_name"], ["game_name"]):
        expected = sorted(map(str, merge.newest_copy(made, keys).collect()))
        assert sorted(map(str, merge.newest_staged(made, keys).collect())) == expected


def test_a_batch_of_distinct_keys_is_not_shuffled(spark):
    assert "Exchange" not in plan(merge.newest_staged(views.feedback(spark, SF)))


@pytest.mark.parametrize("broadcast", [0, 1, 100])
def test_known_keys_of_any_number(spark, monkeypatch, broadcast):
    monkeypatch.setattr(merge, "BROADCAST_KEYS", broadcast)
    batch = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d"), ("4", "e")], "k string, v string")
    for known, left in (([], "abcde"), (["1"], "bcde"), (["1", None, "9"], "bce"), (["1", "2", "4", None], "")):
        existing = spark.createDataFrame([(k,) for k in known], "k string")
        assert "".join(sorted(r.v for r in merge.not_yet_in(batch, existing, ["k"]).collect())) == left


def test_a_batch_of_unknown_keys_is_returned_as_it_is(spark):
    batch = views.feedback(spark, SF)
    assert merge.not_yet_in(batch, batch.limit(0)) is batch


def test_a_source_is_landed_when_asked_for(spark):
    key = (spark.sparkContext.applicationId, SF)
    before = views._landed.pop(key, None)
    try:
        path = views.landed(spark, SF)["forum"]
        assert list(views.landed(spark, SF)) == ["forum"] and path == views.landed(spark, SF)["forum"]
        files = spark.read.text(f"{path}/comments").inputFiles()
        assert files and all(file.endswith(".json.gz") for file in files)
    finally:
        views._landed.pop(key, None)
        if before is not None:
            views._landed[key] = before


def test_rows_are_not_sorted_to_meet_many_answers(spark, monkeypatch):
    from feedloom.operators import inference

    monkeypatch.setattr(inference, "BROADCAST_CHARS", 10)
    rows = spark.range(50).select(F.col("id").cast("string").alias("content_id"), F.concat(F.lit("text "), F.col("id") % 40).alias("t"))
    answered = inference.infer(rows, F.col("t"), "answer", lambda: lambda texts: [t.upper() for t in texts], hot_share=1)
    assert "ShuffledHashJoin" in plan(answered) and "SortMergeJoin" not in plan(answered)
    assert sorted((r.t.upper(), r.answer) for r in answered.collect()) == sorted((r.t.upper(),) * 2 for r in rows.collect())


def test_kept_rows_are_compressed(spark):
    from feedloom.operators.hashed import HashedRows

    kept = HashedRows(spark, fresh_path(spark, "kept"), spark.range(0).schema, ["id"])
    kept.create()
    kept.add(spark.range(5), 1)
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(kept.runs()[0].path).inputFiles())


@pytest.mark.parametrize("broadcast", [0, 1, 100])
def test_newest_edit_of_any_number_of_ids(spark, monkeypatch, broadcast):
    from feedloom.sources.ingest import newest_edit

    monkeypatch.setattr(merge, "BROADCAST_KEYS", broadcast)
    rows = [("a", "1", 1), ("a", "1", 2), ("b", "1", 1), ("b", "2", 5), ("b", "2", 5), ("a", None, 1), ("a", None, 1), ("a", None, 2), ("c", "3", None), ("c", "3", 0)]
    made = spark.createDataFrame(rows, "app_id string, id string, edited int")
    found = newest_edit(made, ["app_id"], "id", [F.col("edited")]).collect()
    expected = [("a", "1", 2), ("b", "1", 1), ("b", "2", 5), ("a", None, 1), ("a", None, 2), ("c", "3", 0)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_rows_landed_once_are_not_shuffled_to_find_their_newest_edit(spark):
    from feedloom.sources.ingest import ingest

    assert "Exchange" not in plan(ingest(spark, "Steam Review", views.landed(spark, SF)["steam"]))


@pytest.mark.parametrize("in_folders", [True, False])
def test_reviews_in_folders_of_their_app_are_written_as_they_lie(spark, database, monkeypatch, in_folders):
    from feedloom.plans import runs
    from feedloom.streaming import upsert as upserts

    spread, write = [], tables.write_batch

    def seen(rows, table, batch_id, **options):
        spread.append(options["spread"])
        write(rows, table, batch_id, **options)

    apps = views.apps(spark, SF).withColumn("content_type", F.lit("Steam Review"))
    path = views.landed(spark, SF)["steam"]
    if not in_folders:
        copy = fresh_path(spark, "no-folders")
        spark.read.json(path).write.json(copy)
        path = copy
    chain = streams.Chain(database, fresh_path(spark, "by-app"), translate=views.translate_none, extract=views.answer)
    known = spark.createDataFrame([("s0", "Steam Review", r.game_name) for r in apps.collect()], "content_id string, content_type string, game_name string")
    known = known.withColumn("content_id", F.concat("content_id", F.lit("-"), "game_name"))
    for column, kind in (("content_text", "string"), ("timestamp", "timestamp"), ("author_id", "string"), ("content_metadata", "string")):
        known = known.withColumn(column, F.lit(None).cast(kind))
    upsert(known, chain.table(streams.BRONZE))
    monkeypatch.setattr(upserts, "write_batch", seen)
    runs.run_refresh(spark, chain, {"Steam Review": path}, apps)
    assert spread == [not in_folders]
    n = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/events.parquet"), F.expr("doc_id = event_id")).count()
    assert tables.items_of(spark, chain.table(streams.BRONZE)).where("content_text IS NOT NULL").count() == n


def test_pages_are_put_together_without_a_shuffle(spark):
    docs = views.documents_with_events(spark, SF)
    assert "Exchange" not in plan(docs.groupBy("source", "page").agg(F.collect_list("text")))


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_rows_beside_known_ones_are_written_as_they_lie(spark, database, monkeypatch, broadcast):
    from dataclasses import replace

    monkeypatch.setattr(merge, "BROADCAST_KEYS", broadcast)
    spread, write = [], tables.write_batch

    def seen(rows, table, batch_id, **options):
        spread.append(options.get("spread", True))
        write(rows, table, batch_id, **options)

    chain = streams.Chain(database, translate=views.translate_none, extract=views.answer, quarantine=True)
    for rows in (views.first_delivery(spark, SF), views.feedback(spark, SF)):
        upsert(rows, chain.table(streams.BRONZE))
        monkeypatch.setattr(streams, "write_batch", seen)
        spread.clear()
        streams.refresh(spark, replace(chain, checkpoints=fresh_path(spark, "once-more")))
    assert any(spread) == (broadcast == 0)
    n = views.feedback(spark, SF).count()
    kept, broken = (spark.table(chain.table(name)).count() for name in (streams.PARSED, streams.QUARANTINE))
    assert kept + broken == n == spark.table(chain.table(streams.EXTRACTED)).count()
