"""Landed files with their quirks, and what ingest makes of them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import unify
from feedloom.sources import landed
from feedloom.sources.ingest import ingest


def review(number, **more):
    return {
        "recommendationid": str(number),
        "author": {"steamid": 76561198000000000 + number, "num_reviews": 3},
        "review": f"text {number}",
        "timestamp_created": 1_700_000_000 + number,
        "weighted_vote_score": 0.5,
        **more,
    }


def write(path, *lines, start=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(start + "\n".join(json.dumps(line) for line in lines), encoding="utf-8")


def test_steam_pages(spark, tmp_path):
    pages = [{"reviews": [review(1), review(2)], "cursor": "x"}, {"reviews": [], "cursor": "y"}, {"reviews": None}]
    write(tmp_path / "app_id=0042" / "a.json", *pages, start="﻿")
    write(tmp_path / "app_id=7" / "b.json", {"reviews": [review(3, voted_up=True)]})
    rows = landed.read_steam(spark, str(tmp_path))
    found = {r.recommendationid: (r.app_id, r.author["steamid"], r.voted_up) for r in rows.collect()}
    assert found == {
        "1": ("0042", "76561198000000001", None),
        "2": ("0042", "76561198000000002", None),
        "3": ("7", "76561198000000003", True),
    }


def test_one_response_per_file(spark, tmp_path):
    text = json.dumps({"reviews": [review(1), review(2)], "cursor": "x"}, indent=2)
    (tmp_path / "page.json").write_text(text)
    assert landed.read_steam(spark, str(tmp_path), multiline=True).count() == 2


def test_steam_ingest_of_one_app(spark, tmp_path):
    write(tmp_path / "app_id=1" / "a.json", {"reviews": [review(n) for n in range(30)]})
    write(tmp_path / "app_id=2" / "a.json", {"reviews": [review(n) for n in range(100, 130)]})
    rows = ingest(spark, "Steam Review", str(tmp_path), app_id="1", game_name="O'Neil", cap=20, sample=10)
    found = rows.collect()
    assert rows.columns == list(schemas.FEEDBACK_COLUMNS)
    assert len(found) == 10 and {r.game_name for r in found} == {"O'Neil"}
    assert all(10 <= int(r.content_id) < 30 for r in found)
    metadata = json.loads(found[0].content_metadata)
    assert metadata["author"]["num_reviews"] == "3" and "voted_up" not in metadata
    every = ingest(spark, "Steam Review", str(tmp_path), cap=20)
    assert {(r.game_name, r["count"]) for r in every.groupBy("game_name").count().collect()} == {("1", 20), ("2", 20)}


def test_listed_games_only(spark, tmp_path):
    write(tmp_path / "app_id=1" / "a.json", {"reviews": [review(1)]})
    write(tmp_path / "app_id=2" / "a.json", {"reviews": [review(2)]})
    games = spark.createDataFrame([("2", "Two")], "app_id string, game_name string")
    rows = ingest(spark, "Steam Review", str(tmp_path), games=games)
    assert [(r.content_id, r.game_name) for r in rows.collect()] == [("2", "Two")]


def test_play(spark, tmp_path):
    write(
        tmp_path / "a.json",
        {"reviewId": "1", "userName": "u", "content": "c", "score": 5, "at": "2024-01-02T03:04:05Z", "language": "en"},
        {"reviewId": "2", "userName": "u", "content": "c", "score": 1, "at": "2024-01-02T03:04:05Z", "language": "xx"},
    )
    every = ingest(spark, "Google Play Review", str(tmp_path), app_id="com.game", game_name="Game")
    assert sorted(r.content_id for r in every.collect()) == ["1", "2"]
    rows = ingest(
        spark, "Google Play Review", str(tmp_path), app_id="com.game", game_name="Game", languages=["en"]
    )
    row = rows.withColumn("timestamp", F.col("timestamp").cast("string")).first()
    assert rows.count() == 1
    assert (row.content_id, row.game_name, row.author_id, row.timestamp) == ("1", "Game", "u", "2024-01-02 03:04:05")
    assert json.loads(row.content_metadata) == {"score": 5}


def test_forum(spark, tmp_path):
    post = {"id": "p", "title": "t", "score": 1, "created_utc": "2024-01-02T03:04:05Z", "permalink": "/r/x/1", "subreddit": "x"}
    write(tmp_path / "posts" / "a.json", post, {**post, "id": "old", "created_utc": "2020-01-01T00:00:00Z"})
    comments = [
        {"post_id": p, "comment_id": f"{p}{n}", "body": "b", "author": "a", "score": n, "created_utc": "2024-01-03T00:00:00Z"}
        for p in ("p", "old", "gone")
        for n in range(5)
    ]
    write(tmp_path / "comments" / "a.json", *comments)
    assert landed.read_posts(spark, str(tmp_path / "posts")).first().permalink == "https://reddit.com/r/x/1"
    from datetime import date

    rows = ingest(spark, "Reddit Post", str(tmp_path), max_comments=2, asof=date(2024, 2, 1))
    found = rows.orderBy("content_id").collect()
    assert [r.content_id for r in found] == ["p3", "p4"]
    assert {r.content_type for r in found} == {"Reddit Comment"} and {r.game_name for r in found} == {"x"}
    assert json.loads(found[0].content_metadata)["post_text"] == ""


def test_nothing_landed_gives_an_empty_frame(spark, tmp_path):
    write(tmp_path / "a.json", {"reviews": [], "cursor": "x"})
    rows = ingest(spark, "Steam Review", str(tmp_path), app_id="1", game_name="g")
    assert rows.count() == 0 and rows.columns == list(schemas.FEEDBACK_COLUMNS)


def test_unknown_content_type(spark):
    with pytest.raises(ValueError, match="unknown content type"):
        ingest(spark, "Letter", "/nowhere")


def test_conform_orders_casts_and_needs_every_column(spark):
    row = spark.range(1).select(
        F.lit(None).cast("timestamp").alias("timestamp"),
        *[F.lit(1).alias(c) for c in schemas.FEEDBACK_COLUMNS if c != "timestamp"],
    )
    assert tuple(unify.conform(row).first()) == ("1", "1", "1", "1", None, "1", "1")
    with pytest.raises(ValueError, match="missing columns: author_id"):
        unify.conform(row.drop("author_id"))


def test_newest_edit_of_redelivered_reviews(spark, tmp_path):
    old, new = review(1), review(1)
    old.update(review="zzz", timestamp_updated=5)
    new.update(review="aaa", timestamp_updated=9)
    nameless = {**review(2), "recommendationid": None}
    other = {**nameless, "review": "another"}
    for n in range(3):
        write(tmp_path / "app_id=1" / f"{n}.json", {"reviews": [old, new, nameless, other]})
    rows = ingest(spark, "Steam Review", str(tmp_path)).collect()
    assert sorted((r.content_id or "", r.content_text) for r in rows) == sorted(
        [("1", "aaa"), ("", nameless["review"]), ("", "another")]
    )


def test_until(spark, tmp_path):
    from datetime import datetime

    write(tmp_path / "a.json", *[{"reviewId": str(d), "at": f"2024-01-0{d}T00:00:00Z", "language": "en"} for d in (1, 2, 3)])
    rows = ingest(spark, "Google Play Review", str(tmp_path), app_id="g", until=datetime(2024, 1, 2))
    assert sorted(r.content_id for r in rows.collect()) == ["1", "2"]
