"""First n rows of every group, exact, also when one group holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.plans.staging import stage

# What one task is given to rank of a single group; a bound on memory, results do not depend on it.
ROWS_PER_TASK = 1_000_000

_TRIM = "spark.sql.optimizer.windowGroupLimitThreshold"


def first_n(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    bucket: Column | None = None,
    slice_on: str | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows per group in ``order``, which must be total.

    Every task sends at most ``n`` rows per group into the shuffle. That is
    enough for a small ``n``. Otherwise pass ``bucket``, an integer that never
    decreases along ``order``: a histogram of it, a few numbers per group, tells
    which rows can be among the first ``n``, and the others stay where they are while
    the cut-offs, a line per group, are small enough to broadcast; beyond that all rows meet
    their cut-off in a shuffle by group. The histogram and the cut-offs are jobs that run
    while the plan is made.
    If even those are too many for one task, because a third of all rows fell
    into one bucket, they are ranked in slices by the hash of ``slice_on`` first,
    as often as it takes.
    """
    _trim_in_tasks(df.sparkSession, n)
    if bucket is not None:
        df, most = _up_to_cutoff(df, by, bucket, n)
        room = max(ROWS_PER_TASK, 4 * n)
        while slice_on is not None and most > room:
            slices = -(-most // room)
            # A new seed in every round, or a slice would fall together again.
            part = F.pmod(F.xxhash64(F.lit(most), slice_on), F.lit(slices))
            df = _rank(df.withColumn("_slice", part), [*by, "_slice"], order, n).drop("_slice")
            most = slices * n
    return _rank(df, by, order, n)


def _rank(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def _trim_in_tasks(spark: SparkSession, n: int) -> None:
    """Let Spark cut groups to ``n`` rows before the shuffle, not only up to 1000.

    The setting stays raised in the session: the plan is made when the result is used.
    """
    if int(spark.conf.get(_TRIM)) < n:
        spark.conf.set(_TRIM, n)


def _up_to_cutoff(
    df: DataFrame, by: Sequence[str], bucket: Column, n: int
) -> tuple[DataFrame, int]:
    """Rows that can be among the first ``n``, and how many the largest group has."""
    counts = df.groupBy(*by, bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    so_far = F.sum("_rows").over(Window.partitionBy(*by).orderBy("_bucket"))
    needed = counts.withColumn("_before", so_far - F.col("_rows")).where(F.col("_before") < n)
    cutoffs = needed.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(
        F.max("_bucket").alias("_cutoff"), F.sum("_rows").alias("_rows")
    )
    cutoffs = stage(cutoffs, "cutoffs")
    most = cutoffs.agg(F.max("_rows")).first()[0] or 0
    same_group = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    kept = df.join(cutoffs.drop("_rows"), [*same_group, bucket <= F.col("_cutoff")])
    return kept.drop("_cutoff", *[f"_by_{c}" for c in by]), most
