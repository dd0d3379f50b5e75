"""Insert-only upsert into an item table, from a batch or a stream."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame

from feedloom import schemas
from feedloom.operators.key_index import KeyIndex
from feedloom.operators.merge import new_rows, with_ids
from feedloom.operators.tables import batch_name, create_item_table, fills_files, location, write_batch
from feedloom.plans.staging import scratch


# An index of up to so many bytes is joined as it is; of a larger one the keys in question are written down first.
SMALL_INDEX = 10_000_000


def upsert(
    rows: DataFrame, table: str, keys: Sequence[str] = ("content_id",), ddl: str = schemas.FEEDBACK
) -> None:
    """Add the rows whose key is new; rows already there stay as they are.

    Rows without an id are told apart by all their columns. What is staged on the
    way is removed.
    """
    create_item_table(rows.sparkSession, table, ddl)
    _merge(rows, table, keys, f"run-{uuid4().hex}")


def _merge(rows: DataFrame, table: str, keys: Sequence[str], name: str, by_game: bool = False) -> None:
    """Write the new rows as one batch; which keys are known the table's index tells.

    The batch is written down first, since it is used several times, unless it lies in files. Of the index only buckets
    are read that its keys can be in. Rows that come ``by_game``, and many rows of few games, are not shuffled for the
    write, unless they were for their keys.
    """
    spark = rows.sparkSession
    with scratch(spark):
        index = KeyIndex(spark, table, location(spark, table), keys)

        def known(asked: DataFrame) -> tuple[DataFrame | None, bool]:
            return index.known(asked, but=name), index.size <= SMALL_INDEX

        new, moved = new_rows(with_ids(rows), known, keys)
        spread = moved or not (by_game or fills_files(new))
        index.announce(name)
        write_batch(new, table, name, spread=spread)
        index.settle(name)


def upsert_stream(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = ("content_id",),
    ddl: str = schemas.FEEDBACK,
    by_game: bool = False,
) -> None:
    """Upsert what a stream has to offer and stop; a replayed batch adds nothing.

    ``by_game`` says that rows come, without a shuffle between, from files of one game each: a task then writes
    no more files than it reads.
    """
    create_item_table(rows.sparkSession, table, ddl)

    def write(batch: DataFrame, number: int) -> None:
        _merge(batch, table, keys, batch_name(checkpoint, number), by_game)

    stream = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
