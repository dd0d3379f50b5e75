"""What is shuffled and written grows no faster than the input, also above the limits of broadcasts."""

from __future__ import annotations

import re
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from checks import stream, views
from feedloom.operators import merge, tables
from feedloom.plans.staging import fresh_path
from feedloom.streaming import chain as streams
from feedloom.streaming import upsert as upserts
from feedloom.streaming.upsert import upsert

SF = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark):
    name = f"grows_{uuid4().hex}"
    tables.use_database(spark, name, fresh_path(spark, name))
    return name


def shuffles(df):
    """Exchanges of a plan that are no broadcasts."""
    return re.findall(r"(?<!Broadcast)Exchange \S+", df._jdf.queryExecution().executedPlan().toString())


def staged_by(monkeypatch, module):
    names, stage = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: names.append(name) or stage(df, name))
    return names


@pytest.mark.parametrize("tied", [False, True])
def test_many_repeated_keys_do_not_move_the_batch(spark, monkeypatch, tied):
    monkeypatch.setattr(merge, "BROADCAST_KEYS", 0)
    rows = views.second_delivery(spark, SF)
    rows = rows.unionByName(rows.where("content_id % 7 = 0")) if tied else rows
    expected = sorted(map(str, merge.newest_copy(rows).collect()))
    names = staged_by(monkeypatch, merge)
    found = merge.newest_staged(rows)
    assert not shuffles(found) and ("newest" in names) == tied
    assert sorted(map(str, found.collect())) == expected


def test_newest_of_many_with_nulls_and_places_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(merge, "BROADCAST_KEYS", 0)
    rows = spark.range(0, 90_000, 1, 2).select(
        F.expr("IF(id % 11 = 0, NULL, CAST(id % 40000 AS STRING))").alias("k"),
        F.expr("IF(id % 5 = 0, NULL, timestamp_seconds(id % 60000))").alias("timestamp"),
        F.expr("CAST(id % 3 AS STRING)").alias("v"),
    )
    found, expected = merge.newest_staged(rows, ["k"]), merge.newest_copy(rows, ["k"])
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_many_known_and_many_new_keys_do_not_move_the_batch(spark, monkeypatch):
    monkeypatch.setattr(merge, "BROADCAST_KEYS", 0)
    rows = views.feedback(spark, SF)
    known = rows.where("content_id % 3 = 0").select(F.col("content_id").alias("_known_content_id"))
    new, moved = merge.new_rows(rows, lambda asked: (known, False), ["content_id"])
    assert not moved and not shuffles(new) and new.columns == rows.columns
    assert sorted(map(str, new.collect())) == sorted(map(str, rows.where("content_id % 3 <> 0").collect()))


def test_texts_do_not_meet_the_first_delivery(spark):
    later = stream.not_delivered_first(spark, SF)
    assert not shuffles(later)
    assert later.count() == views.feedback(spark, SF).where("timestamp >= timestamp'2024-01-02 12:00:00'").count()


@pytest.mark.parametrize(("name", "id_col"), [("documents", "doc_id"), ("conversations", "conv_id")])
def test_events_of_no_document_or_conversation_are_left_out(spark, tmp_path, name, id_col):
    for n in ("events", name):
        spark.read.parquet(f"{SF}/{n}.parquet").write.parquet(f"{tmp_path}/{n}.parquet")
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.withColumn("event_id", F.col("event_id") + 10_000_000).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    ids = spark.read.parquet(f"{SF}/{name}.parquet").select(F.col(id_col).alias("event_id")).distinct()
    found = views.events_of(spark, str(tmp_path), name, id_col)
    assert found.agg(F.max("event_id")).first()[0] <= ids.agg(F.max("event_id")).first()[0]
    assert found.join(ids, "event_id").count() == events.join(ids, "event_id").count()
    spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    assert views.events_of(spark, str(tmp_path), name, id_col).isEmpty()


@pytest.mark.parametrize("least", [1, 12_000, 2**40])
def test_large_batches_are_merged_without_a_shuffle(spark, database, monkeypatch, least):
    monkeypatch.setattr(tables, "LARGE", least)
    plans, own = [], tables._rows_to_merge

    def seen(*args):
        plans.append(own(*args))
        return plans[-1]

    monkeypatch.setattr(tables, "_rows_to_merge", seen)
    table = f"`{database}`.bronze"
    for part in ("content_id % 9 = 0", "content_id % 9 <> 0"):
        upsert(views.feedback(spark, SF).where(part), table)
    before = sorted(map(str, tables.items_of(spark, table).collect()))
    assert len(tables.compact(spark, table, 1)) == 2
    assert (not shuffles(plans[0])) == (least == 1)
    assert sorted(map(str, tables.items_of(spark, table).collect())) == before
    assert len(tables.batches(spark, table)) == 1


def test_rows_that_are_only_counted_are_not_written_down(spark, database, monkeypatch):
    counts = []
    chain = streams.Chain(database, translate=views.translate_none, extract=views.answer, on_quality=counts.append)
    upsert(views.feedback(spark, SF), chain.table(streams.BRONZE))
    names = staged_by(monkeypatch, streams)
    streams.refresh(spark, chain)
    assert "marked" not in names
    kept = spark.table(chain.table(streams.PARSED)).count()
    n = views.feedback(spark, SF).count()
    assert [(c["rows"], c["valid_overall_sentiment"]) for c in counts] == [(n, n - kept)] and kept < n
    assert spark.table(chain.table(streams.QUARANTINE)).isEmpty()


def test_rows_that_lie_in_files_are_not_written_down(spark, database, monkeypatch):
    names = staged_by(monkeypatch, merge)
    rows = views.feedback(spark, SF)
    for n, keys in enumerate((["content_id"], ["content_type", "content_id"])):
        for _ in range(2):
            upsert(rows, f"{database}.lie{n}", keys)
            assert "batch" not in names
        assert tables.items_of(spark, f"{database}.lie{n}").exceptAll(rows.select(*spark.table(f"{database}.lie{n}").drop("batch_id").columns)).isEmpty()
        assert spark.table(f"{database}.lie{n}").count() == rows.count()
    upsert(rows.where("content_id > '5'").unionByName(rows), f"{database}.both")
    assert "batch" in names and spark.table(f"{database}.both").count() == rows.count()


def test_what_lies_in_files(spark, tmp_path):
    from feedloom.plans.staging import lies_in_files

    path = f"{tmp_path}/rows"
    spark.range(9).select(F.col("id"), F.col("id").cast("string").alias("s")).write.parquet(path)
    rows = spark.read.parquet(path)
    assert lies_in_files(rows) and lies_in_files(rows.withColumn("t", F.upper("s")).select("t", F.lit(1).alias("one")))
    shout = F.udf(lambda s: s.upper())
    for other in (
        rows.where("id > 3"), rows.withColumn("now", F.current_timestamp()), rows.withColumn("r", F.rand()), rows.withColumn("u", shout("s")),
        rows.unionByName(rows), rows.join(rows.select("id"), "id"), rows.distinct(), rows.limit(3), spark.range(5),
        rows.selectExpr("*", "(SELECT max(id) FROM range(3)) AS m"), spark.createDataFrame([(1,)], "id int"),
    ):
        assert not lies_in_files(other)
    rows.write.json(f"{path}-json")
    assert not lies_in_files(spark.read.json(f"{path}-json"))


@pytest.mark.parametrize("broadcast", [0, 1, 10**6])
def test_rows_are_found_again_in_files_of_one_name(spark, database, tmp_path, monkeypatch, broadcast):
    """Folders of partitions hold files of the same name; rows come twice, are known, have no key."""
    monkeypatch.setattr(merge, "BROADCAST_KEYS", broadcast)
    monkeypatch.setattr(upserts, "SMALL_INDEX", -1)
    made = spark.range(0, 4000, 1, 1).select(
        F.expr("IF(id % 13 = 0, NULL, CAST(id % 1500 AS STRING))").alias("content_id"), F.lit("t").alias("content_type"),
        F.expr("CAST(id % 4 AS STRING)").alias("game_name"), F.expr("CONCAT('text ', id)").alias("content_text"),
        F.expr("timestamp_seconds(id % 2900)").alias("timestamp"), F.lit("a").alias("author_id"), F.lit("{}").alias("content_metadata"),
    )
    made.write.partitionBy("game_name").parquet(f"{tmp_path}/rows")
    rows = spark.read.schema(made.schema).parquet(f"{tmp_path}/rows")
    assert len({file.rsplit("/", 1)[1] for file in rows.inputFiles()}) == 1 < len(rows.inputFiles())
    first = rows.where("content_id < '3'")
    upsert(first, f"{database}.lie")
    upsert(rows, f"{database}.lie")
    keyed = merge.with_ids(rows)
    expected = merge.newest_copy(merge.with_ids(first)).unionByName(merge.newest_copy(keyed).where("content_id LIKE 'row-%' OR content_id >= '3'"))
    found = tables.items_of(spark, f"{database}.lie").select(*expected.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_a_table_can_be_upserted_from_itself(spark, database):
    table = f"{database}.own"
    upsert(views.feedback(spark, SF), table)
    n = spark.table(table).count()
    for times in (2, 3):
        rows = tables.items_of(spark, table).withColumn("content_id", F.concat("content_id", F.lit("-b")))
        upsert(rows, table)
        assert spark.table(table).count() == times * n


@pytest.mark.parametrize(("least", "writers"), [(1, 32), (2**40, 32), (1, 3)])
def test_many_rows_of_few_games_are_written_as_they_lie(spark, database, monkeypatch, least, writers):
    monkeypatch.setattr(tables, "LEAST_FILE", least)
    monkeypatch.setattr(tables, "_WRITERS", writers)
    spread, write = [], tables.write_batch

    def seen(rows, table, batch_id, **options):
        spread.append(options["spread"])
        write(rows, table, batch_id, **options)

    monkeypatch.setattr(upserts, "write_batch", seen)
    rows = views.feedback(spark, SF)
    for n in (1, 2):
        upsert(rows, f"{database}.few")
        assert spark.table(f"{database}.few").count() == rows.count()
    # The second time all are known: nothing is left to fill files with.
    assert spread == [least > 1 or writers == 3, True]


def test_joined_documents_are_one_file_for_each_bucket(spark):
    files = views.documents_with_events(spark, SF).inputFiles()
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
