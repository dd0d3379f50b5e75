"""Caps and samples against brute force, with one group holding most rows."""

from __future__ import annotations

import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from feedloom.plans import ranking
from feedloom.plans.ranking import first_n
from feedloom.sources import bounds


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    made = []
    for number in range(6000):
        group = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        # Few distinct times, some missing, so that ties and NULLs decide.
        seconds = rng.choice([None, *range(0, 90_000, 600)])
        made.append((f"id{number}", group, seconds, rng.choice(["en", "fr", "de"])))
    df = spark.createDataFrame(made, "id string, grp string, seconds long, language string")
    return made, df.repartition(7).withColumn("at", F.timestamp_seconds("seconds"))


def expected(made, key, order, n):
    groups = {}
    for row in made:
        groups.setdefault(key(row), []).append(row)
    return {row[0] for group in groups.values() for row in sorted(group, key=order)[:n]}


def newest_first(row):
    return (row[2] is None, -(row[2] or 0), row[0])


def ids(df):
    found = [row.id for row in df.select("id").collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("n", [1, 5, 40, 1500, 100_000])
def test_newest(rows, n):
    made, df = rows
    found = ids(bounds.newest(df, ["grp"], F.col("at"), "id", n))
    assert found == expected(made, lambda r: r[1], newest_first, n)


def test_newest_by_language(rows):
    made, df = rows
    found = ids(bounds.newest_by_language(df, ["grp"], F.col("at"), "id", 30))
    known = [row for row in made if row[3] in ("en", "fr")]
    assert found == expected(known, lambda r: (r[1], r[3]), newest_first, 30)


@pytest.mark.parametrize("n", [1, 17, 2000])
@pytest.mark.parametrize("capped", [False, True])
def test_sample(rows, n, capped):
    made, df = rows
    found = ids(bounds.sample_threshold(df, ["grp"], "id", n, capped=capped))

    def draw(row):
        return md5(("sample" + row[0]).encode()).hexdigest(), row[0]

    assert found == expected(made, lambda r: r[1], draw, n)


def test_sample_keeps_small_groups_whole(rows):
    made, df = rows
    assert bounds.sample_threshold(df, ["grp"], "id", 10**6).count() == len(made)


def test_cutoff_moves_few_rows(rows):
    """Only rows at or before the cutoff reach the shuffle."""
    _, df = rows
    kept, most = ranking._up_to_cutoff(df, ["grp"], bounds.hours_back(F.col("at")), 10)
    # 25 hours of times, one in 151 rows without any: four groups, one hour of each.
    assert 4 * 10 <= kept.count() < 800
    assert most == max(r["count"] for r in kept.groupBy("grp").count().collect())


def test_one_bucket_with_everything_is_ranked_in_slices(rows, monkeypatch):
    made, df = rows
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", 100)
    order = [F.col("at").desc_nulls_last(), F.col("id")]
    found = first_n(df, ["grp"], order, 8, bucket=F.lit(0), slice_on="id")
    assert ids(found) == expected(made, lambda r: r[1], newest_first, 8)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # 4000 rows in slices of 100, then 43 * 8 survivors, then the last 4 * 8.
    assert plan.count("Window [") == 3


def test_groups_are_trimmed_before_the_shuffle(rows):
    _, df = rows
    for n in (3, 5000):
        plan = first_n(df, ["grp"], [F.col("id")], n)._jdf.queryExecution().executedPlan()
        assert plan.toString().index("Exchange") < plan.toString().rindex("WindowGroupLimit")


def test_top_posts_and_comments(spark):
    posts = spark.createDataFrame(
        [(f"p{i}", "forum" if i < 40 else "small", i % 7) for i in range(45)],
        "id string, subreddit string, score int",
    )
    best = {(r.subreddit, r.id) for r in bounds.top_posts(posts, 3).collect()}
    assert best == {
        ("forum", "p13"), ("forum", "p20"), ("forum", "p27"),
        ("small", "p41"), ("small", "p40"), ("small", "p44"),
    }


def test_catalogue_search(spark):
    apps = spark.createDataFrame(
        [("1", "NBA 2K25"), ("", "nba 2k24"), (None, "nba 2k23"), ("4", "Chess"), ("5", None)],
        "appid string, name string",
    )
    assert [r.appid for r in bounds.search_catalogue(apps, "nba 2K").collect()] == ["1"]
