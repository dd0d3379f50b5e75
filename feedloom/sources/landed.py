"""Readers of landed review and forum payloads (JSON lines), batch or stream.

Review files may lie in ``app_id=…`` folders; the folder name becomes a column,
always text, and a filter on it skips the other folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas


def _json(
    spark: SparkSession, path: str, ddl: str, *, stream: bool, multiline: bool = False
) -> DataFrame:
    # A stream reads files of any age: a copy tool may keep the times of files.
    reader = spark.readStream.option("maxFileAge", "36500d") if stream else spark.read
    return reader.schema(ddl).option("multiLine", multiline).json(path)


def read_steam(
    spark: SparkSession, path: str, *, stream: bool = False, multiline: bool = False
) -> DataFrame:
    """One row per review out of response pages ``{"reviews": […], "cursor": …}``."""
    ddl = f"{schemas.STEAM_PAGE}, app_id string"
    pages = _json(spark, path, ddl, stream=stream, multiline=multiline)
    return pages.select("app_id", F.inline("reviews"))


def read_play(spark: SparkSession, path: str, *, stream: bool = False) -> DataFrame:
    return _json(spark, path, f"{schemas.PLAY_REVIEW}, app_id string", stream=stream)


def by_app(spark: SparkSession, path: str) -> bool:
    """Whether all that landed in a folder lies in ``app_id=…`` folders, a file holding one app."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = (status.getPath().getName() for status in files.globStatus(folder.suffix("/*")) or ())
    return all(name.startswith(("app_id=", "_", ".")) for name in names)


def read_posts(spark: SparkSession, path: str, *, stream: bool = False) -> DataFrame:
    posts = _json(spark, path, schemas.FORUM_POST, stream=stream)
    link = F.concat(F.lit(schemas.FORUM_BASE_URL), F.col("permalink"))
    return posts.withColumn("permalink", link)


def read_comments(spark: SparkSession, path: str, *, stream: bool = False) -> DataFrame:
    return _json(spark, path, schemas.FORUM_COMMENT, stream=stream)


def with_post(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Each comment with its post's title and text (missing text is ``""``)."""
    context = posts.select(
        F.col("id").alias("post_id"),
        "subreddit",
        F.col("title").alias("post_title"),
        F.coalesce("selftext", F.lit("")).alias("post_text"),
    )
    joined = comments.join(context, "post_id")
    return joined.select(*comments.columns, "post_title", "post_text", "subreddit")
