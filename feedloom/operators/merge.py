"""Duplicate removal and insert-only upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.plans.ranking import first_n
from feedloom.plans.staging import lies_in_files, stage

# So many keys, some 50 MB, are broadcast; results do not depend on it.
BROADCAST_KEYS = 500_000


def with_ids(df: DataFrame, id_col: str = "content_id") -> DataFrame:
    """Rows without an id get one made from all their columns, the same each time."""
    whole = F.to_json(F.struct(*sorted(df.columns)))
    return df.withColumn(id_col, F.coalesce(id_col, F.concat(F.lit("row-"), F.md5(whole))))


def edited_at(df: DataFrame, time: str) -> list[Column]:
    """When a row was last edited, by its metadata if these say so, then its time."""
    return [c.desc_nulls_last() for c in _edited(df, time)]


def _edited(df: DataFrame, time: str) -> list[Column]:
    order = [F.col(time)]
    if "content_metadata" in df.columns:
        edited = F.get_json_object("content_metadata", "$.timestamp_updated").cast("long")
        order.insert(0, F.coalesce(edited, F.unix_seconds(time)))
    return order


def newest_copy(df: DataFrame, keys: Sequence[str] = ("content_id",), time: str = "timestamp") -> DataFrame:
    """One row per key, the last edited; every task sends at most one row per key."""
    rest: list[Column] = [F.col(c) for c in df.columns if c not in (*keys, time)]
    return first_n(df, keys, [*edited_at(df, time), *rest], 1)


def newest_staged(rows: DataFrame, keys: Sequence[str] = ("content_id",), time: str = "timestamp") -> DataFrame:
    """:func:`newest_copy`, written down. Only keys are shuffled to find those that come more than once, and
    only rows of such keys meet each other. If these are many, only their times do, and rows as new as each other."""
    return _newest_staged(rows, keys, time).drop(*_PLACE)


def _newest_staged(rows: DataFrame, keys: Sequence[str], time: str = "timestamp", lie: bool = False) -> DataFrame:
    """The same, with the place of each row. Rows that ``lie`` in files are read there again, not written down."""
    batch = rows if lie else stage(rows, "batch")
    several = batch.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    several = stage(several.select(*[F.col(k).alias(f"_known_{k}") for k in keys]), "several")
    n = several.count()
    batch = _placed(batch, "file_path" if lie else "file_name")
    if not n:
        return batch
    if n > BROADCAST_KEYS:
        return _newest_of_many(batch, several, keys, time)
    several = F.broadcast(several)
    newest = newest_copy(batch.join(several, _same(keys), "left_semi"), keys, time)
    return batch.join(several, _same(keys), "left_anti").unionByName(stage(newest, "newest"))


def _newest_of_many(batch: DataFrame, several: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Without the older rows of the keys in ``several``, found by keys, times and places. Of rows as new as
    each other, which alone are shuffled whole, one stays by its other columns."""
    dated = batch.select(*keys, F.struct(*_edited(batch, time)).alias("_at"), *_PLACE)
    dated = stage(dated.join(several.hint("shuffle_hash"), _same(keys), "left_semi"), "dated")
    last = dated.groupBy(*keys).agg(F.max("_at").alias("_last"))
    last = last.withColumnsRenamed({k: f"_known_{k}" for k in keys}).hint("shuffle_hash")
    met = dated.join(last, _same(keys)).select(*keys, *_PLACE, F.col("_at").eqNullSafe(F.col("_last")).alias("_newest"))
    met = stage(met, "met")
    tied = met.where("_newest").groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    tied = stage(known_keys(tied, keys), "tied")
    older = met.where("NOT _newest").select(*_PLACE)
    if tied.isEmpty():
        return _at_places(batch, older, False)
    equal = met.where("_newest").join(tied.hint("shuffle_hash"), _same(keys), "left_semi").select(*_PLACE)
    one = stage(newest_copy(_at_places(batch, equal, True), keys, time), "newest")
    return _at_places(batch, older.unionByName(equal), False).unionByName(one)


# Where a row lies: its file and its number in it.
_PLACE = ("_file", "_row")
# Rows of a file whose bits lie together.
_BITS = 32_768


def _placed(rows: DataFrame, file: str) -> DataFrame:
    return rows.select("*", F.col(f"_metadata.{file}").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _at_places(rows: DataFrame, places: DataFrame, among: bool) -> DataFrame:
    """Rows whose place is among ``places``, or not. A bit for each row of a file is broadcast, no key."""
    bucket = F.floor(F.col("_row") / _BITS).alias("_bucket")
    bits = places.groupBy("_file", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_row") + 1)).alias("_bits"))
    bits = stage(bits, "bits")
    byte = F.expr(f"CAST(conv(hex(substring(_bits, CAST(_row % {_BITS} AS INT) DIV 8 + 1, 1)), 16, 10) AS INT)")
    held = F.coalesce(F.getbit(byte, (F.col("_row") % 8).cast("int")) == 1, F.lit(False))
    marked = rows.withColumn("_bucket", bucket).join(F.broadcast(bits), ["_file", "_bucket"], "left")
    return marked.where(held if among else ~held).select(*rows.columns)


def not_yet_in(batch: DataFrame, existing: DataFrame, keys: Sequence[str] = ("content_id",)) -> DataFrame:
    """Rows of ``batch`` whose key ``existing`` does not hold; NULL equals NULL in a key.

    Only the key columns of ``existing`` are read, cut to the keys of the batch.
    While those are small enough to broadcast, the table is scanned and never
    shuffled; beyond that it is shuffled with them on the key. The batch itself, texts
    and all, is shuffled only if many of its keys are known and many others are not. If
    none is known, it is returned as it is.
    """
    return without_known(batch, known_keys(existing, keys), keys)


def known_keys(existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    return existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])


def without_known(batch: DataFrame, known: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not among ``known``, whose columns are named ``_known_`` and the key's name.

    ``small`` says that all of ``known`` can be broadcast.
    """
    return unknown_rows(batch, known, keys, small)[0]


def unknown_rows(
    batch: DataFrame, known: DataFrame, keys: Sequence[str], small: bool = False
) -> tuple[DataFrame, bool]:
    """The same as :func:`without_known`, and whether all rows are shuffled: never if they come with their places."""
    if small:
        return batch.join(F.broadcast(known), _same(keys), "left_anti"), False
    known = stage(known.join(batch.select(*keys), _same(keys), "left_semi"), "known")
    n = known.count()
    if n <= BROADCAST_KEYS:
        return batch.join(F.broadcast(known), _same(keys), "left_anti") if n else batch, False
    if set(_PLACE) <= set(batch.columns):
        fresh = batch.select(*keys, *_PLACE).join(known, _same(keys), "left_anti")
        return _at_places(batch, fresh.select(*_PLACE), True), False
    fresh = stage(batch.select(*keys).join(known, _same(keys), "left_anti"), "fresh")
    fresh = fresh.withColumnsRenamed({k: f"_known_{k}" for k in keys})
    few = fresh.count() <= BROADCAST_KEYS
    fresh = F.broadcast(fresh) if few else fresh.hint("shuffle_hash")
    return batch.join(fresh, _same(keys), "left_semi"), not few


def _same(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]


def new_rows(
    rows: DataFrame, known: Callable[[DataFrame], tuple[DataFrame | None, bool]], keys: Sequence[str]
) -> tuple[DataFrame, bool]:
    """The newest copy of each key that is not known, and whether all rows are shuffled to find them.

    ``known`` gives, for rows, keys as ``_known_`` columns, NULL if none is known, and whether these are few.
    Rows are written down first, unless they lie in files: then the result must be used before these change.
    """
    new = _newest_staged(rows, keys, lie=lies_in_files(rows))
    found, small = known(new)
    new, moved = (new, False) if found is None else unknown_rows(new, found, keys, small)
    return new.drop(*_PLACE), moved


def insert_only(
    batch: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = ("content_id",),
    time: str = "timestamp",
) -> DataFrame:
    """Rows an insert-only merge adds: new keys, one row each.

    The batch is written down first: it is used twice, and only its true size
    tells the planner whether its keys can be broadcast.
    """
    return not_yet_in(newest_staged(batch, keys, time), existing, keys)


def batch_profile(df: DataFrame, id_col: str = "content_id") -> DataFrame:
    """Rows and distinct ids of a batch, in one pass."""
    return df.agg(
        F.count("*").alias("row_count"), F.count_distinct(id_col).alias("distinct_ids")
    )
