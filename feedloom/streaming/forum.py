"""Forum files read once, as they land: a comment waits until its post is there.

Posts are kept, hashed by their id, since any later comment may need one; comments without their
post are kept likewise until it lands. A batch of comments reads only buckets of posts it may be
under, a batch of posts only buckets of comments that may wait for it. Posts come first in
every run, so that nothing waits for a post of its own delivery. A replayed batch adds nothing: what it
joins goes through an insert-only upsert, and what it keeps is kept under its number.

A comment gets the title and text its post has when the two meet; comments without a post id belong
to no post. How many comments one post has does not matter: they wait in several places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.operators.hashed import HashedRows
from feedloom.plans.staging import scratch, stage
from feedloom.sources import landed
from feedloom.sources.ingest import newest_edit

_POSTS = "id string, subreddit string, title string, selftext string, created_utc timestamp, num_comments int"
# Places in which the comments of one post wait.
PLACES = 16


class ForumStore:
    """Posts seen so far, and comments that wait for one, in a folder. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.posts = HashedRows(spark, f"{folder}/posts", T.StructType.fromDDL(_POSTS), ["id"])
        waiting = T.StructType.fromDDL(f"{schemas.FORUM_COMMENT}, place int")
        self.waiting = HashedRows(spark, f"{folder}/waiting", waiting, ["post_id", "place"])

    def posts_of(self, comments: DataFrame) -> DataFrame | None:
        """The newest edit of each post the comments are under, written down; NULL if there is none."""
        asked = comments.select(F.col("post_id").alias("id"))
        found = self.posts.candidates(asked)
        if found is None:
            return None
        return stage(_newest(found.drop("_run").join(asked, "id", "left_semi")), "posts")

    def waiting_for(self, posts: DataFrame) -> DataFrame | None:
        """Comments that wait for one of the posts."""
        places = F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1))).alias("place")
        found = self.waiting.candidates(posts.select(F.col("id").alias("post_id"), places))
        return None if found is None else found.drop("_run", "place")

    def keep_posts(self, posts: DataFrame, version: int) -> None:
        if not _has(self.posts, version):
            self.posts.add(posts, version)

    def keep_waiting(self, comments: DataFrame, version: int) -> None:
        """Comments without their post; those that met theirs since leave when runs are merged."""
        if not _has(self.waiting, version):
            place = F.pmod(F.xxhash64("comment_id"), F.lit(PLACES)).cast("int")
            self.waiting.add(comments.withColumn("place", place), version, self._without_post)

    def _without_post(self, comments: DataFrame) -> DataFrame:
        known = self.posts_of(comments)
        if known is None:
            return comments
        return comments.join(known.select(F.col("id").alias("post_id")), "post_id", "left_anti")


def _has(rows: HashedRows, version: int) -> bool:
    return any(run.first <= version <= run.last for run in rows.runs())


def _newest(posts: DataFrame) -> DataFrame:
    return newest_edit(posts, [], "id", [F.col("created_utc"), F.col("num_comments")])


def join_landed(spark: SparkSession, path: str, folder: str, take: Callable[[DataFrame], None]) -> None:
    """Read what landed below ``path`` since the last run; ``take`` gets comments with their post.

    ``folder`` holds checkpoints and what is kept. A pair that a replay or another delivery joins again is given to ``take`` again.
    """
    store = ForumStore(spark, f"{folder}/kept")

    def posts(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            known = batch.where("id IS NOT NULL").select(T.StructType.fromDDL(_POSTS).fieldNames())
            new = stage(_newest(known), "posts")
            waiting = store.waiting_for(new)
            if waiting is not None:
                take(landed.with_post(waiting, new))
            store.keep_posts(new, number)

    def comments(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            own = batch.where("post_id IS NOT NULL")
            new = stage(newest_edit(own, ["post_id"], "comment_id", [F.col("created_utc")]), "comments")
            known = store.posts_of(new)
            if known is not None:
                take(landed.with_post(new, known))
                new = new.join(known.select(F.col("id").alias("post_id")), "post_id", "left_anti")
            store.keep_waiting(new, number)

    for name, read, write in (("posts", landed.read_posts, posts), ("comments", landed.read_comments, comments)):
        rows = read(spark, f"{path}/{name}", stream=True).writeStream.foreachBatch(write)
        rows.option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start().awaitTermination()
