"""Forum files as they land: late posts, replays, forums that are new to a folder."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import hashed
from feedloom.plans.staging import fresh_path
from feedloom.streaming.forum import ForumStore, join_landed


def post(number, **more):
    return {"id": f"p{number}", "title": f"t{number}", "created_utc": "2024-01-01T00:00:00Z", "num_comments": 1, "subreddit": "x", **more}


def comment(number, of, **more):
    return {"post_id": of, "comment_id": f"c{number}", "body": "b", "author": "a", "score": 1, "created_utc": "2024-01-02T00:00:00Z", **more}


@pytest.fixture
def forum(spark, tmp_path):
    """Lands a delivery, runs the join over what is new, and says which pairs it took."""
    folder, count = fresh_path(spark, "forum"), 0

    def deliver(posts, comments):
        nonlocal count
        count += 1
        for name, rows in (("posts", posts), ("comments", comments)):
            (tmp_path / name).mkdir(exist_ok=True)
            if rows:
                (tmp_path / name / f"{count}.json").write_text("\n".join(map(json.dumps, rows)))
        taken = []
        join_landed(
            spark, str(tmp_path), folder, lambda df: taken.extend((r.comment_id, r.post_title) for r in df.collect())
        )
        return sorted(taken)

    return deliver


def test_a_comment_waits_for_its_post(forum):
    odd = [comment(8, None), comment(9, "never")]
    assert forum([post(1)], [comment(1, "p1"), comment(2, "p2"), *odd]) == [("c1", "t1")]
    assert forum([], []) == []
    # A post brings what waited; one that is there already takes new comments; the newest edit counts.
    assert forum([post(2), post(2, title="new", num_comments=5)], [comment(3, "p1")]) == [("c2", "new"), ("c3", "t1")]
    assert forum([post(1, title="later", created_utc="2024-01-05T00:00:00Z")], [comment(4, "p1"), comment(5, "p2")]) == [
        ("c4", "later"),
        ("c5", "new"),
    ]


def test_what_met_its_post_leaves_when_runs_are_merged(spark, monkeypatch):
    monkeypatch.setattr(hashed, "FAN", 2)
    monkeypatch.setattr(hashed, "PER_BUCKET", 2000)
    store = ForumStore(spark, fresh_path(spark, "forum"))
    posts = spark.range(40).select(F.concat(F.lit("p"), "id").alias("id"), F.lit("x").alias("subreddit"))
    posts = posts.selectExpr("*", "id AS title", "id AS selftext", "timestamp'2024-01-01' AS created_utc", "1 AS num_comments")
    waits = spark.range(900).selectExpr(
        "CASE WHEN id < 400 THEN 'p1' ELSE concat('p', id) END AS post_id", "concat('c', id) AS comment_id",
        "'b' AS body", "'a' AS author", "1 AS score", "timestamp'2024-01-02' AS created_utc",
    )
    store.keep_waiting(waits, 0)
    store.keep_waiting(waits, 0)  # a replay
    assert sum(store.waiting._rows(r).count() for r in store.waiting.runs()) == 900
    found = store.waiting_for(posts).join(posts.select(F.col("id").alias("post_id")), "post_id")
    assert found.count() == 400
    assert found.columns == [c.split()[0] for c in schemas.FORUM_COMMENT.split(", ")]
    # The comments of one post wait in several buckets.
    assert store.waiting.runs()[0].buckets > 1
    store.keep_posts(posts, 0)
    store.keep_waiting(waits.limit(0), 1)
    store.keep_waiting(waits.where("comment_id = 'c899'").withColumn("comment_id", F.lit("more")), 2)
    while len(store.waiting.runs()) > 1:
        store.keep_waiting(waits.limit(1).withColumn("post_id", F.lit("never")), 3 + len(store.waiting.runs()))
    (run,) = store.waiting.runs()
    left = {r.post_id for r in store.waiting._rows(run).collect()}
    assert "p1" not in left and "p899" in left


def test_a_forum_that_is_new_to_a_folder(spark, tmp_path):
    from uuid import uuid4

    from feedloom.operators import tables
    from feedloom.plans import runs
    from feedloom.streaming.chain import BRONZE, Chain

    name = f"test_{uuid4().hex}"
    tables.use_database(spark, name, fresh_path(spark, name))
    chain = Chain(name)
    for part, rows in (("posts", [post(1), post(2, subreddit="y")]), ("comments", [comment(1, "p1"), comment(2, "p2")])):
        (tmp_path / part).mkdir()
        (tmp_path / part / "1.json").write_text("\n".join(map(json.dumps, rows)))

    def known(*forums):
        apps = spark.createDataFrame([(f, f) for f in forums], "app_id string, game_name string")
        tables.create_item_table(spark, chain.table(BRONZE), schemas.FEEDBACK)
        runs._upsert_landed(spark, chain, schemas.FORUM, str(tmp_path), apps)
        return sorted(r.content_id for r in spark.table(chain.table(BRONZE)).collect())

    read = []
    before, runs._landed_before = runs._landed_before, lambda *a: read.append(a[-1]) or before(*a)
    try:
        assert known("x") == ["c1"] and read == []
        assert known("x", "y") == ["c1", "c2"] and read == [["y"]]
        assert known("x", "y") == ["c1", "c2"] and len(read) == 1
    finally:
        runs._landed_before = before
