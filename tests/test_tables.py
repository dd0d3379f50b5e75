"""Merging, replays, deletes, odd game names."""

from __future__ import annotations

from dataclasses import replace
from types import SimpleNamespace
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import merge, tables
from feedloom.operators.metrics import in_range
from feedloom.plans.staging import fresh_path, shared_dir
from feedloom.streaming import chain as streams
from feedloom.streaming.upsert import upsert, upsert_stream


@pytest.fixture
def database(spark):
    name = f"test_{uuid4().hex}"
    tables.use_database(spark, name, fresh_path(spark, name))
    return name


def feedback(spark, rows):
    made = spark.createDataFrame(rows, "content_id string, game_name string, content_text string, day string")
    return made.select(
        "content_id",
        F.lit(schemas.STEAM).alias("content_type"),
        "game_name",
        "content_text",
        F.col("day").cast("timestamp").alias("timestamp"),
        F.lit("a").alias("author_id"),
        F.lit('{"language":"en"}').alias("content_metadata"),
    )


ODD = "O'Neil / 100% \\ =game"


def ids(spark, table):
    return sorted(r.content_id for r in spark.table(table).collect())


def test_merge_twice_adds_nothing(spark, database):
    table = f"{database}.bronze"
    rows = feedback(spark, [("1", ODD, "old", "2024-01-01"), ("1", ODD, "new", "2024-01-02"), ("2", "g", "x", None)])
    for _ in range(2):
        upsert(rows, table)
    kept = {r.content_id: r.content_text for r in spark.table(table).collect()}
    assert kept == {"1": "new", "2": "x"} and spark.table(table).count() == 2


def test_existing_rows_stay_as_they_are(spark, database):
    table = f"{database}.bronze"
    upsert(feedback(spark, [("1", "g", "first", "2024-01-01")]), table)
    upsert(feedback(spark, [("1", "g", "later", "2024-02-01"), ("3", "g", "z", "2024-01-01")]), table)
    assert {(r.content_id, r.content_text) for r in spark.table(table).collect()} == {("1", "first"), ("3", "z")}


def test_key_of_two_columns(spark, database):
    table = f"{database}.bronze"
    for game in ("g", "h", "g"):
        upsert(feedback(spark, [("1", game, "x", "2024-01-01")]), table, keys=("content_id", "game_name"))
    assert sorted(r.game_name for r in spark.table(table).collect()) == ["g", "h"]


def test_empty_batch(spark, database):
    table = f"{database}.bronze"
    upsert(feedback(spark, []), table)
    assert spark.table(table).count() == 0
    assert set(schemas.FEEDBACK_COLUMNS) < set(spark.table(table).columns)


def test_small_batch_leaves_the_table_unshuffled(spark, database):
    table = f"{database}.bronze"
    upsert(feedback(spark, [(str(i), "g", "x", "2024-01-01") for i in range(50)]), table)
    path = fresh_path(spark, "batch")
    feedback(spark, [("7", "g", "x", "2024-01-01"), ("70", "g", "x", "2024-01-01")]).write.parquet(path)
    batch = spark.read.schema(schemas.FEEDBACK).parquet(path)
    new = merge.not_yet_in(batch, spark.table(table))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") >= 1
    assert [r.content_id for r in new.collect()] == ["70"]


def test_delete_takes_one_game_from_every_table(spark, database):
    upsert(feedback(spark, [("1", ODD, "x", "2024-01-01"), ("2", "g", "x", "2024-01-01")]), f"{database}.bronze")
    upsert(feedback(spark, [("3", ODD, "x", "2024-01-01")]), f"{database}.bronze")
    plain = spark.createDataFrame([(ODD, 1), ("g", 2), (None, 3)], "game_name string, n int")
    plain.write.format("parquet").saveAsTable(f"{database}.totals")
    spark.createDataFrame([(1,)], "n int").write.format("parquet").saveAsTable(f"{database}.unrelated")
    names = tables.tables_with_games(spark, database)
    assert len(names) == 2

    def audit():
        return {r.table_name: r.row_count for r in tables.audit_counts(spark, names, ODD).collect()}

    assert audit() == {"bronze": 2, "totals": 1}
    tables.delete_game(spark, names, ODD)
    assert audit() == {"bronze": 0, "totals": 0}
    assert ids(spark, f"{database}.bronze") == ["2"]
    assert sorted(r.n for r in spark.table(f"{database}.totals").collect()) == [2, 3]
    tables.delete_game(spark, names, "no such game")
    assert ids(spark, f"{database}.bronze") == ["2"]


def test_a_batch_written_again_replaces_itself(spark, database):
    table = f"{database}.bronze"
    tables.create_item_table(spark, table, schemas.FEEDBACK)
    first = feedback(spark, [("1", "g", "x", "2024-01-01"), ("2", "h", "x", "2024-01-01")])
    tables.write_batch(first, table, "b-0")
    tables.write_batch(first, table, "b-0")
    tables.write_batch(feedback(spark, [("3", "g", "x", "2024-01-01")]), table, "b-1")
    assert ids(spark, table) == ["1", "2", "3"]


def test_replayed_upstream_batch_adds_nothing_downstream(spark, database):
    chain = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"))
    bronze = chain.table(streams.BRONZE)
    rows = feedback(spark, [("1", "g", "good", "2024-01-01"), ("2", ODD, "bad price", "2024-01-01")])
    upsert(rows, bronze)
    streams.refresh(spark, chain)
    # The same rows again in new files, as after a batch that was cut short.
    again = spark.table(bronze)
    batch = again.first().batch_id
    tables.write_batch(rows, bronze, batch)
    streams.refresh(spark, chain)
    for name in (streams.TRANSLATED, streams.EXTRACTED, streams.PARSED, streams.ITEMS):
        assert ids(spark, chain.table(name)) == ["1", "2"]
    topics = {(r.content_id, r.category) for r in spark.table(chain.table(streams.TOPICS)).collect()}
    assert topics == {("2", "monetization"), ("2", "other")}
    assert spark.table(chain.table(streams.TOPICS)).count() == 2


@pytest.mark.parametrize("listed", [0, 1000])
def test_rows_back_in_bronze_are_not_doubled_downstream(spark, database, monkeypatch, listed):
    monkeypatch.setattr(streams, "MAX_LISTED_GAMES", listed)
    chain = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"))
    bronze = chain.table(streams.BRONZE)
    rows = feedback(spark, [("1", ODD, "good", "2024-01-01"), ("2", None, "bad", "2024-01-01")])
    for _ in range(2):
        upsert(rows, bronze)
        streams.refresh(spark, chain)
        tables.delete_game(spark, [bronze], ODD)
        assert ids(spark, chain.table(streams.ITEMS)) == ["1", "2"]


def test_stream_equals_batch_in_small_steps(spark, database):
    quality = []
    chain = streams.Chain(
        database,
        checkpoints=fresh_path(spark, "checkpoints"),
        files_per_batch=1,
        on_quality=quality.append,
    )
    rows = feedback(
        spark, [(str(i), f"g{i % 3}", f"good lag {i} price", f"2024-01-0{1 + i % 4}") for i in range(30)]
    )
    rows = rows.unionByName(feedback(spark, [("blank", "g0", " ", "2024-01-01")]))
    upsert(rows, chain.table(streams.BRONZE))
    streams.refresh(spark, chain)
    assert sum(counts["rows"] for counts in quality) == 31
    assert sum(counts["valid_overall_sentiment"] for counts in quality) == 1
    items, topics = streams.enrich(rows, chain)
    for name, batch in ((streams.ITEMS, items), (streams.TOPICS, topics)):
        table = tables.items_of(spark, chain.table(name)).select(*batch.columns)
        assert sorted(map(str, table.collect())) == sorted(map(str, batch.collect()))
        assert spark.table(chain.table(name)).select("batch_id").distinct().count() > 1


def test_a_new_category_adds_columns(spark, database):
    some = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"), categories=["character"])
    more = replace(some, categories=["character", "game_performance"])
    for number, chain in enumerate((some, more, more)):
        rows = feedback(spark, [(str(number), "g", "hero lag", f"2024-01-0{number + 1}")])
        upsert(rows, chain.table(streams.BRONZE))
        streams.refresh(spark, chain)
    parsed = spark.table(more.table(streams.PARSED)).orderBy("content_id").collect()
    assert [(r.character_sub_topic, r.game_performance_sub_topic) for r in parsed] == [
        ("hero", None), ("hero", "lag"), ("hero", "lag"),
    ]
    topics = spark.table(more.table(streams.TOPICS)).where("category = 'game_performance'")
    assert sorted(r.content_id for r in topics.collect()) == ["1", "2"]


def test_translation_in_the_language_recorded(spark):
    rows = feedback(spark, [("1", "g", "le jeu", "2024-01-01")])
    for recorded, text in (("french", "the game"), ("fr", "the game"), ("english", "le jeu")):
        metadata = F.to_json(F.struct(F.lit(recorded).alias("language")))
        translated = streams.translate_offline(rows.withColumn("content_metadata", metadata))
        assert translated.first().translated_content_text == text


def test_stream_upsert_shares_a_table_with_batches(spark, database):
    table = f"{database}.bronze"
    upsert(feedback(spark, [("1", "g", "batch", "2024-01-01")]), table)
    path = fresh_path(spark, "delivery")
    feedback(spark, [("1", "g", "stream", "2024-02-01"), ("2", "g", "stream", "2024-02-01")]).write.parquet(path)
    rows = spark.readStream.schema(schemas.FEEDBACK).parquet(path)
    checkpoint = fresh_path(spark, "upsert")
    for _ in range(2):
        upsert_stream(rows, table, checkpoint)
    assert {(r.content_id, r.content_text) for r in spark.table(table).collect()} == {("1", "batch"), ("2", "stream")}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_without_a_shared_folder_only_a_local_session_runs():
    def session(master):
        state = {"folder": None}
        context = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: state["folder"],
            setCheckpointDir=lambda folder: state.update(folder=f"{folder}/1"),
        )
        return SimpleNamespace(conf={"spark.sql.warehouse.dir": "wh"}, sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local) == "wh/_shared/1"


def test_game_and_range_reach_the_scan(spark, database):
    table = f"{database}.bronze"
    upsert(feedback(spark, [("1", ODD, "x", "2024-01-01"), ("2", "007", "x", "2024-01-01")]), table)
    chosen = in_range(tables.items_of(spark, table), "2024-01-01", "2024-01-02", "007")
    scan = chosen.select("content_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_name" in scan and "PushedFilters: [IsNotNull(timestamp)" in scan
    assert "ReadSchema: struct<content_id:string,timestamp:timestamp>" in scan
    assert [r.content_id for r in chosen.collect()] == ["2"]
    only = streams.new_rows(spark, table, schemas.FEEDBACK)
    assert dict(only.dtypes)["game_name"] == "string"


def test_a_batch_written_again_leaves_no_game_behind(spark, database):
    table = f"{database}.bronze"
    tables.create_item_table(spark, table, schemas.FEEDBACK)
    rows = feedback(spark, [("1", "a", "x", "2024-01-01"), ("2", ODD, "x", "2024-01-01"), ("3", None, "x", "2024-01-01")])
    tables.write_batch(rows, table, "x")
    tables.write_batch(rows, table, "other")
    tables.write_batch(rows.where("content_id = '1'"), table, "x")
    assert ids(spark, table) == ["1", "1", "2", "3"]


def test_the_same_id_of_two_games(spark, database):
    """A game's row stays whatever other games a batch holds, and however games are looked up."""
    for listed in (0, 1000):
        chain = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"), keys=("content_id", "game_name"))
        bronze = chain.table(streams.BRONZE)
        spark.sql(f"DROP TABLE IF EXISTS {bronze}")
        for name in (streams.TRANSLATED, streams.EXTRACTED, streams.PARSED, streams.ITEMS, streams.TOPICS):
            spark.sql(f"DROP TABLE IF EXISTS {chain.table(name)}")
        streams.MAX_LISTED_GAMES, before = listed, streams.MAX_LISTED_GAMES
        try:
            for rows in ([("1", "a", "good", "2024-01-01")], [("1", "a", "good", "2024-01-01"), ("1", "b", "bad", "2024-01-01")]):
                upsert(feedback(spark, rows), bronze, chain.keys)
                streams.refresh(spark, chain)
        finally:
            streams.MAX_LISTED_GAMES = before
        found = spark.table(chain.table(streams.ITEMS)).collect()
        assert sorted((r.content_id, r.game_name) for r in found) == [("1", "a"), ("1", "b")]


def test_the_last_edit_wins(spark):
    rows = feedback(spark, [("1", "g", "aaa", "2024-01-01"), ("1", "g", "zzz", "2024-01-01")])
    when = F.when(F.col("content_text") == "zzz", "9").otherwise("5")
    rows = rows.withColumn("content_metadata", F.concat(F.lit('{"timestamp_updated":'), when, F.lit("}")))
    assert [r.content_text for r in merge.newest_copy(rows).collect()] == ["zzz"]


def test_rows_of_null_keys_are_matched(spark):
    left = spark.createDataFrame([(None, "a"), ("1", None), ("2", "b")], "content_id string, content_type string")
    right = left.where("content_id IS NULL OR content_id = '1'")
    assert [r.content_id for r in merge.not_yet_in(left, right, ["content_id", "content_type"]).collect()] == ["2"]


def test_old_files_that_land_late_are_read(spark, database):
    import os
    import time

    path = fresh_path(spark, "late").removeprefix("file:")
    checkpoint = fresh_path(spark, "late-checkpoint")
    rows = [feedback(spark, [(str(i), "g", "x", "2024-01-01")]) for i in range(2)]
    for i, part in enumerate(rows):
        part.coalesce(1).write.mode("append").parquet(path)
        if i:
            month_ago = time.time() - 30 * 86400
            newest = max((f for f in os.listdir(path) if f.startswith("part-")), key=lambda f: os.path.getmtime(f"{path}/{f}"))
            os.utime(f"{path}/{newest}", (month_ago, month_ago))
        stream = spark.readStream.schema(schemas.FEEDBACK).option("maxFileAge", streams.MAX_FILE_AGE).parquet(path)
        upsert_stream(stream, f"{database}.bronze", checkpoint)
    assert ids(spark, f"{database}.bronze") == ["0", "1"]


def test_nothing_staged_is_left_behind(spark, database):
    import glob

    root = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/staged/run-*"))
    chain = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"))
    upsert(feedback(spark, [("1", "g", "good", "2024-01-01")]), chain.table(streams.BRONZE))
    streams.refresh(spark, chain)
    assert set(glob.glob(f"{root}/staged/run-*")) == before


def test_audit_of_no_tables(spark):
    assert tables.audit_counts(spark, [], "g").count() == 0


def test_refresh_says_what_it_cannot_do(spark, database):
    from feedloom.plans.runs import run_refresh

    chain = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"))
    upsert(feedback(spark, [("1", "g", "good", "2024-01-01")]), chain.table(streams.BRONZE))
    games = spark.createDataFrame([], "content_type string, app_id string, game_name string")
    with pytest.raises(ValueError, match="no path for known content types: Steam Review"):
        run_refresh(spark, chain, {}, games)
    with pytest.raises(ValueError, match="no app id for known games, among them: g"):
        run_refresh(spark, chain, {"Steam Review": "/nowhere"}, games)
    with pytest.raises(ValueError, match="unknown content type"):
        run_refresh(spark, chain, {"Stream Review": "/nowhere"}, games)


def test_many_batches_are_brought_together(spark, database, monkeypatch):
    chain = streams.Chain(database, checkpoints=fresh_path(spark, "checkpoints"), most_batches=3)
    bronze = chain.table(streams.BRONZE)
    seen = []
    for run in range(7):
        upsert(feedback(spark, [(f"{run}{g}", name, "good", "2024-01-01") for g, name in enumerate(("a", ODD, None))]), bronze)
        streams.refresh(spark, chain)
        seen.append(len(spark.table(bronze).inputFiles()))
    expected = sorted(f"{run}{g}" for run in range(7) for g in range(3))
    for name in (streams.BRONZE, streams.TRANSLATED, streams.EXTRACTED, streams.PARSED, streams.ITEMS):
        assert ids(spark, chain.table(name)) == expected
        assert spark.sql(f"SHOW PARTITIONS {chain.table(name)}").count() <= 4 * 3
    assert max(seen) <= 4 * 3
    # A crash after the new partitions were added and before the old ones went.
    monkeypatch.setattr(tables, "drop_partitions", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        tables.compact(spark, bronze, 0)
    monkeypatch.undo()
    tables.finish_compaction(spark, bronze)
    assert ids(spark, bronze) == expected
    streams.refresh(spark, chain)
    assert ids(spark, chain.table(streams.ITEMS)) == expected
    tables.delete_game(spark, [bronze], ODD)
    assert ids(spark, bronze) == [i for i in expected if not i.endswith("1")]
