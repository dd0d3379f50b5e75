"""Rows kept to be found by key: runs of hash buckets, a Bloom filter for each bucket, merged by size.

What is added becomes a run of its own. A small run is one bucket; a larger one has so many that each
is of bounded size, and a Bloom filter of each, built where the rows are. Whoever asks for keys
reads the filters, then the buckets that may hold one of them, and no others. Runs of like size
are merged, so that there are logarithmically many, and each row is written again as often at most. A run
appears under its name only once it is complete; one that a merged run covers does not count any more.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import log2
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.staging import COMPRESSION, remove

# Bytes of a bucket: a bound on what one task filters, merges or reads; results do not depend on it.
PER_BUCKET = 8_000_000
# On disk keys are compressed: a task holds at least so many times the bytes.
UNPACKED = 2
# Keys of which one task asks for one bucket.
PER_TASK = 200_000
# So many runs of like size are merged. Below this number of bytes all sizes are alike.
FAN = 8
LEAST = 1_000_000
# Bits of a filter for each row of its bucket, and how many of them a row sets.
BITS, SET = 10, 7
# Buckets of a run that are named one by one; beyond that the whole run is read.
MAX_NAMED = 1000


@dataclass(frozen=True)
class Run:
    """Versions ``first`` to ``last``, in a number of buckets."""

    path: str
    first: int
    last: int
    buckets: int
    size: int

    @property
    def tier(self) -> int:
        return int(log2(max(self.size // LEAST, 1)) / log2(FAN))


class HashedRows:
    """Rows of a schema in a folder, hashed by the columns ``by``."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, by: Sequence[str]) -> None:
        self.spark, self.folder, self.schema, self.by = spark, folder.rstrip("/"), schema, list(by)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files.exists(self._path(self.folder))

    def create(self) -> None:
        self._files.mkdirs(self._path(self.folder))

    def names(self, prefix: str) -> list[str]:
        """Names in the folder that begin with ``prefix``."""
        if not self.exists():
            return []
        found = (s.getPath().getName() for s in self._files.listStatus(self._path(self.folder)))
        return sorted(name for name in found if name.startswith(prefix))

    def runs(self) -> list[Run]:
        """All runs that count, the oldest first."""
        runs = []
        for name in self.names("run-"):
            runs.append(Run(f"{self.folder}/{name}", *map(int, name.split("-")[1:])))
        return [r for r in runs if not any(o.first <= r.first and r.last <= o.last and o != r for o in runs)]

    def add(self, rows: DataFrame, version: int, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Add ``rows`` as a run, then merge runs of like size. ``keep`` sees rows with the
        version of their run in ``_run`` and says which are still worth keeping."""
        path = f"{self.folder}/_new-{uuid4().hex}"
        plain = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*plain, F.lit(0).alias("bucket")).write.option("compression", COMPRESSION).partitionBy("bucket").parquet(path)
        size = self._size(path)
        if size * UNPACKED > PER_BUCKET:
            self._write(self._read(path), size, version, version)
            remove(self.spark, path)
        elif size:
            self._appear(path, version, version, 1, size)
        else:
            remove(self.spark, path)
        while due := self._due():
            parts = reduce(DataFrame.unionByName, [self._rows(run) for run in due])
            parts = parts if keep is None else keep(parts)
            self._write(parts.drop("_run"), sum(r.size for r in due), due[0].first, due[-1].last)
            for run in due:
                remove(self.spark, run.path)

    def _due(self) -> list[Run]:
        """The newest runs up to some tier, if enough of these are of it: they are merged."""
        runs = self.runs()
        for tier in sorted({r.tier for r in runs}):
            older = [i for i, r in enumerate(runs) if r.tier > tier]
            tail = runs[older[-1] + 1 if older else 0 :]
            if sum(r.tier == tier for r in tail) >= FAN:
                return tail
        return []

    def _size(self, path: str) -> int:
        return self._files.getContentSummary(self._path(path)).getLength()

    def _write(self, rows: DataFrame, size: int, first: int, last: int) -> None:
        """A run of as many buckets as its bytes need, by powers of two."""
        buckets = 1 << max(0, (-(-size * UNPACKED // PER_BUCKET) - 1).bit_length())
        path = f"{self.folder}/_new-{uuid4().hex}"
        placed = rows.withColumn("bucket", F.pmod(self._hashes()[0], F.lit(buckets)).cast("int"))
        dealt = placed.repartition("bucket") if buckets > 1 else placed.coalesce(1)
        dealt.write.option("compression", COMPRESSION).partitionBy("bucket").parquet(path)
        if buckets > 1:
            self._filters(path).write.parquet(f"{path}/_filters")
        self._appear(path, first, last, buckets, self._size(path))

    def _appear(self, path: str, first: int, last: int, buckets: int, size: int) -> None:
        name = f"run-{first:012d}-{last:012d}-{buckets}-{size}"
        if not self._files.rename(self._path(path), self._path(f"{self.folder}/{name}")):
            raise OSError(f"cannot move {path} to {name}")

    def _hashes(self) -> list[Column]:
        return [F.xxhash64(F.lit(seed), *self.by) for seed in (1, 2)]

    def _read(self, *paths: str, of: str | None = None) -> DataFrame:
        reader = self.spark.read.schema(T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())]))
        return reader.option("basePath", of or paths[0]).parquet(*paths).drop("bucket")

    def _rows(self, run: Run, buckets: Sequence[int] | None = None) -> DataFrame:
        paths = [run.path] if buckets is None else [f"{run.path}/bucket={b}" for b in buckets]
        return self._read(*paths, of=run.path).withColumn("_run", F.lit(run.last).cast("long"))

    def _filters(self, path: str) -> DataFrame:
        """``bucket, bits``: the Bloom filter of each bucket of a run."""

        # Nested, and built on numpy alone, so that executors need no copy of this package.
        def build(rows: pd.DataFrame) -> pd.DataFrame:
            import numpy as np
            import pandas as pd

            one, two = (rows[c].to_numpy().astype(np.uint64) for c in ("h1", "h2"))
            size = np.uint64(max(64, n_bits * len(rows)) // 8 * 8)
            bits = np.zeros(int(size), np.uint8)
            for k in range(n_set):
                bits[(one + np.uint64(k) * (two | np.uint64(1))) % size] = 1
            return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "bits": [np.packbits(bits).tobytes()]})

        n_bits, n_set = BITS, SET
        schema = T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(path)
        one, two = self._hashes()
        hashed = rows.select("bucket", one.alias("h1"), two.alias("h2"))
        return hashed.groupBy("bucket").applyInPandas(build, "bucket int, bits binary")

    def candidates(self, asked: DataFrame) -> DataFrame | None:
        """Rows of all buckets that may hold a key of ``asked``, with the version of their run in ``_run``.

        NULL if there are none. Which buckets these are is a job while the plan is made: their numbers
        come to the driver, no keys.
        """
        runs = self.runs()
        large = [r for r in runs if r.buckets > 1]
        possible = self._possible(asked, large) if large else {}
        parts = [self._rows(run) for run in runs if run.buckets == 1]
        for run in large:
            found = possible.get(run.last, [])
            if found:
                parts.append(self._rows(run, None if len(found) > MAX_NAMED else sorted(found)))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _possible(self, asked: DataFrame, runs: Sequence[Run]) -> dict[int, list[int]]:
        def test(asks: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            import numpy as np
            import pandas as pd

            hit = False
            if len(asks) and len(filters):
                one, two = (asks[c].to_numpy().astype(np.uint64) for c in ("h1", "h2"))
                bits = np.frombuffer(filters["bits"].iloc[0], np.uint8)
                maybe = np.ones(len(asks), bool)
                for k in range(n_set):
                    at = (one + np.uint64(k) * (two | np.uint64(1))) % np.uint64(8 * len(bits))
                    maybe &= (bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
                hit = bool(maybe.any())
            found = asks[["run", "bucket"]].head(1 if hit else 0)
            return pd.DataFrame(found)

        n_set = SET
        one, two = self._hashes()
        # However few buckets a run has, many keys are dealt to many tasks.
        parts = max(1, -(-asked.count() // (PER_TASK * sum(r.buckets for r in runs))))
        each = F.array(*[F.struct(F.lit(r.last).cast("long").alias("run"), F.lit(r.buckets).alias("buckets")) for r in runs])
        asks = asked.select(one.alias("h1"), two.alias("h2"), F.inline(each))
        asks = asks.withColumns(
            {"bucket": F.pmod("h1", "buckets").cast("int"), "part": F.pmod(F.shiftright("h2", 7), F.lit(parts)).cast("int")}
        ).drop("buckets")
        filters = [self.spark.read.parquet(f"{r.path}/_filters").withColumn("run", F.lit(r.last).cast("long")) for r in runs]
        every = reduce(DataFrame.unionByName, filters).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        keys = ["run", "bucket", "part"]
        hits = asks.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInPandas(test, "run long, bucket int")
        possible: dict[int, list[int]] = {}
        for row in hits.distinct().collect():
            possible.setdefault(row["run"], []).append(row["bucket"])
        return possible

    def put(self, name: str, text: str = "") -> None:
        """A small file beside the runs."""
        stream = self._files.create(self._path(f"{self.folder}/{name}"))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def get(self, name: str) -> str:
        stream = self._files.open(self._path(f"{self.folder}/{name}"))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def drop(self, name: str) -> None:
        remove(self.spark, f"{self.folder}/{name}")


def folders(spark: SparkSession, parent: str, prefix: str) -> Iterator[str]:
    """Paths of the folders below ``parent`` whose names begin with ``prefix``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if status.isDirectory() and status.getPath().getName().startswith(prefix):
            yield status.getPath().toString()
