"""A sample that is kept between deliveries: the rows of smallest hash seen so far, per group.

The smallest of all rows are among the smallest of each delivery, so a delivery is cut to its own
sample before it meets the kept one, and earlier deliveries are never read again. The
result is the sample one draw over all deliveries would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.merge import newest_copy
from feedloom.plans.staging import remove, scratch, stage
from feedloom.sources.bounds import sample_threshold


def merge_samples(
    kept: DataFrame, new: DataFrame, by: Sequence[str], id_col: str, n: int, seed: str = "sample"
) -> DataFrame:
    """The sample of everything ``kept`` was drawn from and of ``new``.

    A row that came before stays as it was; of copies within ``new`` the last edited counts.
    """
    keys = [*by, id_col]
    some = sample_threshold(stage(newest_copy(new, keys), "delivery"), by, id_col, n, seed)
    known = kept.select(*[F.col(k).alias(f"_kept_{k}") for k in keys])
    fresh = some.join(known, [F.col(k).eqNullSafe(F.col(f"_kept_{k}")) for k in keys], "left_anti")
    # Both parts hold at most n rows of a group.
    return sample_threshold(kept.unionByName(fresh), by, id_col, n, seed, capped=True)


class KeptSample:
    """A sample in a folder; each delivery replaces it. One writer at a time."""

    def __init__(
        self, spark: SparkSession, folder: str, by: Sequence[str], id_col: str, n: int = 2000, seed: str = "sample"
    ) -> None:
        self.spark, self.folder, self.by, self.id_col, self.n, self.seed = spark, folder.rstrip("/"), by, id_col, n, seed
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        if not self._files.exists(self._path(self.folder)):
            return []
        names = (s.getPath().getName() for s in self._files.listStatus(self._path(self.folder)))
        return sorted(int(name.removeprefix("v-")) for name in names if name.startswith("v-"))

    def rows(self) -> DataFrame | None:
        """The sample so far; NULL before the first delivery."""
        versions = self._versions()
        return self.spark.read.parquet(f"{self.folder}/v-{versions[-1]}") if versions else None

    def extend(self, new: DataFrame) -> DataFrame:
        """Take a delivery in. The new sample appears as a whole, then the old one goes."""
        versions, kept = self._versions(), self.rows()
        kept = new.limit(0) if kept is None else kept
        path = f"{self.folder}/_new-{uuid4().hex}"
        with scratch(self.spark):
            merge_samples(kept, new, self.by, self.id_col, self.n, self.seed).write.parquet(path)
        name = f"{self.folder}/v-{versions[-1] + 1 if versions else 0}"
        if not self._files.rename(self._path(path), self._path(name)):
            raise OSError(f"cannot move {path} to {name}")
        for version in versions:
            remove(self.spark, f"{self.folder}/v-{version}")
        return self.rows()
