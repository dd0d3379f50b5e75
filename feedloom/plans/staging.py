"""Tables written once between two steps, in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Texts take about two thirds of the bytes they take with Spark's default.
COMPRESSION = "zstd"
# Of tables that stay; texts take a tenth less than at the default of 3, staged ones are not worth the time.
KEPT = {"compression": COMPRESSION, "parquet.compression.codec.zstd.level": "6"}

_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local session without one uses its warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage (a lost executor re-reads files, it does not run a model
    again) and gives the planner the true size, so that a join with the result
    is broadcast only while it is below ``spark.sql.autoBroadcastJoinThreshold``.
    All such tables lie in ``staged`` below the shared folder; those of a
    :func:`scratch` block go when it ends.
    """
    spark = df.sparkSession
    run = _RUN.get()
    path = fresh_path(spark, f"staged/{name}" if run is None else f"{run}/{name}")
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lies_in_files(df: DataFrame) -> bool:
    """Whether ``df`` is nothing but columns of all rows of one parquet table, the same each time: to read these
    again costs less than a copy. The time of day, functions Spark cannot see into and other plans inside are not
    that, nor are some of the rows, for which all would be read again."""
    patterns = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    execution = df._jdf.queryExecution()
    plan = execution.analyzed()
    if not plan.deterministic() or any(
        plan.containsPattern(p) for p in (patterns.CURRENT_LIKE(), patterns.SCALA_UDF(), patterns.PLAN_EXPRESSION())
    ):
        return False
    node = execution.optimizedPlan()
    while node.nodeName() == "Project":
        node = node.child()
    if node.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = node.relation()
    files = relation.getClass().getSimpleName() == "HadoopFsRelation"
    return files and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is removed at its end.

    For steps that write their result before they return. A block inside another
    one leaves the removal to it.
    """
    if _RUN.get() is not None:
        yield
        return
    run = f"staged/run-{uuid4().hex}"
    token = _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(token)
        remove(spark, f"{shared_dir(spark)}/{run}")


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Settings of the session inside the block; a dot in a name is written as two underscores."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies in; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)
