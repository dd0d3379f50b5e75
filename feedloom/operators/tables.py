"""Feedback tables in the catalog: create, append, replace, count, delete.

Item tables are partitioned by ``batch_id`` and ``game_name``: a replayed batch
replaces its own partitions, and a game leaves by its partitions alone, so that
no file another step has read is ever rewritten. An empty game name is no name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from hashlib import md5
from itertools import islice
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.key_index import forget_game
from feedloom.plans.staging import KEPT, remove, settings

PARTITIONS = ("batch_id", "game_name")
# Partitions that are written replace those there; a task that meets few games writes them side by side, without a sort.
_WRITERS = 32
_WRITING = {"spark__sql__sources__partitionOverwriteMode": "dynamic", "spark__sql__maxConcurrentOutputFileWriters": _WRITERS}
# Rows are written as they lie, without a shuffle by game, if files then have so many bytes on average before compression.
LEAST_FILE = 4_000_000
# Partitions one statement drops.
_AT_ONCE = 200
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"
# Names of batches that were merged out of others begin so.
_MERGED = "all-"
# Batches whose partitions have so many bytes on average are merged without a shuffle: their files are large already.
LARGE = 8_000_000
# The table property that names a compaction under way.
_UNDER_WAY = "feedloom.compacting"


def use_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")


def item_table_schema(ddl: str) -> T.StructType:
    """Columns of ``ddl`` with the partition columns last."""
    fields = [f for f in T.StructType.fromDDL(ddl) if f.name not in PARTITIONS]
    fields.append(T.StructField("batch_id", T.StringType()))
    return T.StructType([*fields, T.StructField("game_name", T.StringType())])


def create_item_table(spark: SparkSession, table: str, ddl: str) -> None:
    """Create the table, or add the columns it lacks; older rows have none in them."""
    schema = item_table_schema(ddl)
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema)
        # Kept as an option of the table, so that whatever is inserted is written so.
        empty.write.format("parquet").options(**KEPT).partitionBy(*PARTITIONS).saveAsTable(table)
        return
    present = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in present]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def location(spark: SparkSession, table: str) -> str:
    facts = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    return facts.first()["data_type"]


def batch_name(checkpoint: str, number: int) -> str:
    """Name of a stream's batch, the same on a replay and unlike any other stream's."""
    return f"{md5(checkpoint.encode()).hexdigest()[:8]}-{number}"


def write_batch(rows: DataFrame, table: str, batch_id: str, spread: bool = True) -> None:
    """Make ``rows`` the content of one batch; written again, it replaces itself.

    Partitions that an earlier attempt left under this batch go first, also those of
    games that are not in it any more. Rows are spread by game before the write;
    adaptive execution splits a game that fills more than one task and merges the
    small ones. Rows that come, without a shuffle between, from files of one game each
    need no ``spread``: a task writes no more files than it reads.
    """
    spark = rows.sparkSession
    columns = spark.table(table).columns
    batch = rows.withColumn("batch_id", F.lit(batch_id)).select(*columns)
    drop_partitions(spark, table, {"batch_id": batch_id})
    batch = batch.hint("rebalance", "game_name") if spread else batch
    with settings(spark, **_WRITING):
        batch.write.mode("overwrite").insertInto(table)


def fills_files(rows: DataFrame) -> bool:
    """Whether tasks that write ``rows`` as they lie, a file for each game they meet, need no shuffle by game: they
    meet few games, and files are large. Small batches are not looked at; of others, rows and bytes are counted."""
    spark = rows.sparkSession
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if size < LEAST_FILE * spark.sparkContext.defaultParallelism:
        return False
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in rows.schema if f.dataType == T.StringType()]
    files = rows.select(F.spark_partition_id().alias("_task"), "game_name", sum(texts, F.lit(0)).alias("_bytes"))
    files = files.groupBy("_task", "game_name").agg(F.sum("_bytes").alias("_bytes")).groupBy("_task")
    tasks = files.agg(F.count("*").alias("_files"), F.sum("_bytes").alias("_bytes"))
    most, n, total = tasks.agg(F.max("_files"), F.sum("_files"), F.sum("_bytes")).first()
    return bool(n) and most <= _WRITERS and total >= LEAST_FILE * n


def write_batches(rows: DataFrame, table: str) -> None:
    """Write rows that name their batch; the partitions they fill are replaced."""
    spark = rows.sparkSession
    batch = rows.select(*spark.table(table).columns)
    with settings(spark, **_WRITING):
        batch.hint("rebalance", *PARTITIONS).write.mode("overwrite").insertInto(table)


def batches(spark: SparkSession, table: str) -> set[str]:
    """Names of a table's batches; compaction bounds their number."""
    return {_values(row[0])["batch_id"] for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}


def merged_from(spark: SparkSession, table: str, batch: str) -> list[str]:
    """The batches a merged batch was made of; none for any other."""
    if not batch.startswith(_MERGED):
        return []
    return [row[0] for row in spark.read.text(f"{_compacted(spark, table, batch)}/_old").collect()]


def games_of_batch(spark: SparkSession, table: str, batch: str) -> DataFrame:
    """``_game``: the games that have rows in a batch, from the catalog."""
    shown = spark.sql(f"SHOW PARTITIONS {table} PARTITION (batch_id={_literal(batch)})")
    game = F.regexp_extract("partition", "game_name=(.*)$", 1)
    # The catalog escapes bytes as %XX; a plus sign is one.
    game = F.url_decode(F.replace(game, F.lit("+"), F.lit("%2B")))
    return shown.select(F.when(game != _NO_NAME, game).alias("_game"))


def missing_partitions(spark: SparkSession, table: str, other: str) -> DataFrame:
    """Partitions of ``table`` that ``other`` does not have."""
    shown = spark.sql(f"SHOW PARTITIONS {table}")
    return shown.join(spark.sql(f"SHOW PARTITIONS {other}"), "partition", "left_anti")


def drop_batches(spark: SparkSession, table: str, partitions: DataFrame) -> None:
    """Drop the partitions named in ``partitions``, a bounded number with each statement."""
    specs = (_partition(row[0]) for row in partitions.toLocalIterator())
    while some := list(islice(specs, _AT_ONCE)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(some))


def drop_partitions(spark: SparkSession, table: str, of: dict[str, str]) -> None:
    """Drop all partitions of a batch or of a game.

    Their names come from the catalog, no data is read, and a statement drops a
    bounded number of them.
    """
    spec = ", ".join(f"{name}={_literal(value)}" for name, value in of.items())
    names = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").toLocalIterator()
    specs = (_partition(row[0]) for row in names)
    while some := list(islice(specs, _AT_ONCE)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(some))


def _values(path: str) -> dict[str, str]:
    """``a=1/b=2`` as names and values; values are escaped as in a path."""
    parts = (part.split("=", 1) for part in path.split("/"))
    return {name: unquote(value) for name, value in parts}


def _partition(path: str) -> str:
    """``a=1/b=2`` as the partition of a statement."""
    shown = {k: "NULL" if v == _NO_NAME else _literal(v) for k, v in _values(path).items()}
    return "PARTITION (" + ", ".join(f"{k}={v}" for k, v in shown.items()) + ")"


def compact(spark: SparkSession, table: str, batches: int = 100) -> list[str]:
    """Merge small batches of a table once there are more than ``batches`` of them; their names.

    :func:`to_merge` chooses them by size, so that a row is written again
    logarithmically often. For a table whose rows every reading stream has seen, with no other writer at
    work. The rows are written beside the batches, spread by game (those of large partitions as they lie), in a
    folder that file streams do not look into, so that none of them sees a row again. Then the catalog is turned
    to it: the new partitions are added, the old ones dropped. A table property
    says what is under way; :func:`finish_compaction` ends it after a crash. While there are few
    batches, the catalog's list of partitions is not asked for.
    """
    finish_compaction(spark, table)
    if len(_batch_folders(spark, table)) <= batches:
        return []
    names = spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()
    present = Counter(_values(row[0])["batch_id"] for row in names)
    sizes = {name: _size(spark, path) for name, path in _batch_folders(spark, table).items() if name in present}
    old = to_merge(_beyond_files(sizes), batches)
    if not old:
        return []
    new = f"{_MERGED}{uuid4().hex}"
    folder = _compacted(spark, table, new)
    large = [name for name in old if sizes[name][0] >= LARGE * present[name]]
    with settings(spark, **_WRITING):
        rows = _rows_to_merge(spark, table, old, large)
        rows.write.options(**KEPT).partitionBy("game_name").parquet(folder)
    spark.createDataFrame([(b,) for b in old], "value string").write.text(f"{folder}/_old")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_UNDER_WAY}' = '{new}')")
    finish_compaction(spark, table)
    return old


def _beyond_files(sizes: Mapping[str, tuple[int, int]]) -> dict[str, int]:
    """Bytes beyond what as many of the smallest files take, which is schema and footer: a file of few rows counts as next to nothing."""
    least = min((size // files for size, files in sizes.values() if files), default=0)
    return {name: max(0, size - least * files) for name, (size, files) in sizes.items()}


def _rows_to_merge(spark: SparkSession, table: str, old: Sequence[str], large: Sequence[str]) -> DataFrame:
    """Rows of the batches ``old``, spread by game but for those among ``large``, whose files hold one game each."""
    rows = spark.table(table)
    small = rows.where(F.col("batch_id").isin([b for b in old if b not in large])).hint("rebalance", "game_name")
    as_they_lie = rows.where(F.col("batch_id").isin(list(large)))
    if len(large) == len(old):
        return as_they_lie.drop("batch_id")
    return (as_they_lie.unionByName(small) if large else small).drop("batch_id")


def to_merge(sizes: Mapping[str, int], batches: int) -> list[str]:
    """The batches to merge if there are more than ``batches``: none if not.

    The smallest, so many that half of the allowed number stay, and then every next one
    that is no larger than all before it together. Whatever stays is larger than what is merged.
    """
    if len(sizes) <= batches:
        return []
    by_size = sorted(sizes, key=lambda name: (sizes[name], name))
    n = max(2, len(by_size) - batches // 2)
    total = sum(sizes[name] for name in by_size[:n])
    while n < len(by_size) and sizes[by_size[n]] <= total:
        total += sizes[by_size[n]]
        n += 1
    return by_size[:n]


def _batch_folders(spark: SparkSession, table: str) -> dict[str, str]:
    """Folders of the table's batches, merged ones too, by batch; some may have been emptied."""
    top = location(spark, table).rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("batch_id="):
            found[unquote(name.removeprefix("batch_id="))] = status.getPath().toString()
        elif name.startswith(f"_{_MERGED}"):
            found[name.removeprefix("_")] = status.getPath().toString()
    return found


def _size(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Bytes and files of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.getContentSummary(path)
    return found.getLength(), found.getFileCount()


def finish_compaction(spark: SparkSession, table: str) -> None:
    """Turn the catalog to the compacted rows, if a compaction is under way."""
    set_now = {row[0]: row[1] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    new = set_now.get(_UNDER_WAY)
    if new is None:
        return
    folder = _compacted(spark, table, new)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = (status.getPath() for status in files.listStatus(path) if status.isDirectory())
    specs = (
        f"{_partition(f'batch_id={new}/{p.getName()}')} LOCATION {_literal(p.toString())}"
        for p in found
        if p.getName().startswith("game_name=")
    )
    while some := list(islice(specs, _AT_ONCE)):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(some))
    for row in spark.read.text(f"{folder}/_old").collect():
        drop_partitions(spark, table, {"batch_id": row[0]})
        if row[0].startswith(_MERGED):
            remove(spark, _compacted(spark, table, row[0]))
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{_UNDER_WAY}')")
    spark.catalog.refreshTable(table)


def _compacted(spark: SparkSession, table: str, name: str) -> str:
    return f"{location(spark, table).rstrip('/')}/_{name}"


def items_of(spark: SparkSession, table: str) -> DataFrame:
    """Rows of an item table without the batch they came in."""
    return spark.table(table).drop("batch_id")


def save_reports(reports: DataFrame, table: str, update_type: str) -> None:
    """Replace all reports on a refresh, else add to them."""
    mode = "overwrite" if update_type == "REFRESH" else "append"
    reports.write.format("parquet").mode(mode).saveAsTable(table)


def tables_with_games(spark: SparkSession, database: str) -> list[str]:
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    full = [f"`{database}`.`{name}`" for name in names]
    return [name for name in full if "game_name" in spark.table(name).columns]


def audit_counts(spark: SparkSession, tables: Sequence[str], game_name: str) -> DataFrame:
    """Rows of one game in every table, zero included, in one job."""
    counts = [
        spark.table(table)
        .where(F.col("game_name") == game_name)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(table.split(".")[-1].strip("`")).alias("table_name"), "row_count")
        for table in tables
    ]
    if not counts:
        return spark.createDataFrame([], "table_name string, row_count long")
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def delete_game(spark: SparkSession, tables: Sequence[str], game_name: str) -> None:
    """Remove every row of one game from every table."""
    for table in tables:
        if "batch_id" in spark.table(table).columns:
            drop_partitions(spark, table, {"game_name": game_name})
            forget_game(spark, location(spark, table), game_name)
        else:
            _rewrite_without(spark, table, game_name)


def _rewrite_without(spark: SparkSession, table: str, game_name: str) -> None:
    """Write what stays beside the table and turn the table to it, in one change of the catalog.

    A crash before that change leaves the table as it was.
    """
    others = ~F.col("game_name").eqNullSafe(game_name)
    old = location(spark, table)
    new = f"{old.rstrip('/').split('/_kept-')[0]}/_kept-{uuid4().hex}"
    spark.table(table).where(others).write.parquet(new)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(new)}")
    spark.catalog.refreshTable(table)
    _remove_files(spark, old)


def _remove_files(spark: SparkSession, folder: str) -> None:
    """Delete the files of a folder, but not the folders of later versions in it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    for status in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path):
        if status.isFile():
            remove(spark, status.getPath().toString())


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
