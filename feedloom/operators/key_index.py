"""The keys of an item table, kept beside it so that a merge need not read the table.

Each entry has the key of a row, the batch it came in and its game. A batch is announced before it is
written and indexed from what was written, so that after a crash between the two the next merge
catches up. A game that is deleted is noted with the version up to which its entries no
longer count; merged runs leave them out. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.hashed import HashedRows, folders

_PREFIX = "_keys-"
_AHEAD, _GONE = "ahead-", "gone-"
_NO_GAME = "\0"


def _version(rows: HashedRows) -> int:
    gone = [int(name.split("-")[1]) for name in rows.names(_GONE)]
    return max([0, *(r.last for r in rows.runs()), *gone])


def forget_game(spark: SparkSession, folder: str, game_name: str | None) -> None:
    """Entries of a game, in all indexes of the table in ``folder``, count no longer."""
    for own in folders(spark, folder, _PREFIX):
        rows = HashedRows(spark, own, T.StructType([]), [])
        rows.put(f"{_GONE}{_version(rows):012d}-{uuid4().hex}", _NO_GAME if game_name is None else game_name)


class KeyIndex:
    """The index of one table, which lies in ``folder``, for one set of key columns; built from the
    table if there is none."""

    def __init__(self, spark: SparkSession, table: str, folder: str, keys: Sequence[str]) -> None:
        self.spark, self.table, self.keys = spark, table, list(keys)
        kinds = {f.name: f.dataType for f in spark.table(table).schema}
        fields = [T.StructField(f"key_{k}", kinds[k]) for k in keys]
        fields += [T.StructField(name, T.StringType()) for name in ("batch_id", "game_name")]
        own = f"{folder.rstrip('/')}/{_PREFIX}{md5(','.join(keys).encode()).hexdigest()[:8]}"
        self.rows = HashedRows(spark, own, T.StructType(fields), [f"key_{k}" for k in keys])

    def announce(self, batch_id: str) -> None:
        """Say that a batch is about to be written."""
        self.rows.put(f"{_AHEAD}{batch_id}")

    def settle(self, batch_id: str) -> None:
        """Index what the table holds of an announced batch."""
        self._add(self._entries().where(F.col("batch_id") == batch_id))
        self.rows.drop(f"{_AHEAD}{batch_id}")

    def _catch_up(self) -> None:
        if not self.rows.exists():
            self.rows.create()
            if not self.spark.sql(f"SHOW PARTITIONS {self.table}").isEmpty():
                self._add(self._entries())
        for name in self.rows.names(_AHEAD):
            self.settle(name.removeprefix(_AHEAD))

    def _entries(self) -> DataFrame:
        keys = [F.col(k).alias(f"key_{k}") for k in self.keys]
        return self.spark.table(self.table).select(*keys, "batch_id", "game_name")

    def _add(self, entries: DataFrame) -> None:
        self.rows.add(entries, _version(self.rows) + 1, self._still)
        oldest = min((r.last for r in self.rows.runs()), default=None)
        for name in self.rows.names(_GONE):
            if oldest is None or int(name.split("-")[1]) < oldest:
                self.rows.drop(name)

    def _still(self, entries: DataFrame) -> DataFrame:
        """Entries of games that were not deleted after them."""
        names = self.rows.names(_GONE)
        if not names:
            return entries
        gone = [(self.rows.get(n), int(n.split("-")[1])) for n in names]
        gone = [(None if game == _NO_GAME else game, version) for game, version in gone]
        # One row for each deletion since the oldest run.
        gone = self.spark.createDataFrame(gone, "_gone string, _upto long")
        same = F.col("game_name").eqNullSafe(F.col("_gone")) & (F.col("_run") <= F.col("_upto"))
        return entries.join(gone, same, "left_anti")

    @property
    def size(self) -> int:
        """Bytes of all runs."""
        return sum(r.size for r in self.rows.runs())

    def known(self, asked: DataFrame, but: str | None = None) -> DataFrame | None:
        """Keys of ``asked`` that the table holds, as ``_known_`` columns, perhaps with others; NULL if none can be.

        Entries of the batch ``but`` do not count.
        """
        self._catch_up()
        found = self.rows.candidates(asked.select(*[F.col(k).alias(f"key_{k}") for k in self.keys]))
        if found is None:
            return None
        if but is not None:
            found = found.where(F.col("batch_id") != but)
        return self._still(found).select(*[F.col(f"key_{k}").alias(f"_known_{k}") for k in self.keys])

