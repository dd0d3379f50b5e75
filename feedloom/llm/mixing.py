"""Mix sources to target weights by weighted fair queueing, in DataFrame functions only.

A document's virtual finish time is the number of words its source has handed
out up to and with it, divided by the source's target. Sorting the documents of
all sources by that time and cutting the order where the budget is used up gives
every source its share, however the sources differ in size. A source that must
give more than it holds starts over, up to ``epochs`` times.

Defined cases: a NULL text has no words; a NULL source is a source, the last
one; a document without words is in the mix when its place in the order is;
rows alike in id and text stand at one place of the order, and all of
them are taken or none; an empty table gives an empty table. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.plans.staging import stage

#: A word, by the white space of ASCII.
WORD = r"[^\x20\x09-\x0D]+"

#: Hexadecimal digits of the hash that shuffles; 60 bits fit a long.
_DIGITS = 15
_KEYS = 16**_DIGITS


def words(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, size: Column, text: Column) -> Column:
    """The document's place in the shuffled order of its source; ids that repeat, or are NULL, are told apart by text."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string"), F.lit(":"), digest)
    return F.conv(F.substring(F.md5(name), 1, _DIGITS), 16, 10).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, place`` of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"), F.col(text).alias("text"))
    return rows.withColumn("place", place(F.col("doc_id"), F.col("size"), F.col("text"))).drop("text")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), epochs: int = 3) -> DataFrame:
    """``source, source_size, target`` for each source of ``sized`` rows.

    Sources weigh ``weights``, repeating, by code point with NULL last. They share
    the words of all sources; no target exceeds ``epochs`` times its source, and what
    is above is shared again by weight. There is one row per source, and they are
    put in order in one task.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("n", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.element_at(cycle, F.col("n") % len(weights) + 1))
        .withColumn("cap", epochs * F.col("source_size"))
    )
    everything = Window.partitionBy()
    # The sources that reach their cap are the first ones by cap per weight.
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "n").rowsBetween(Window.unboundedPreceding, -1)
    given, gone = F.coalesce(F.sum("cap").over(by_room), F.lit(0)), F.coalesce(F.sum("weight").over(by_room), F.lit(0))
    shared = (
        sources.withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("left", F.col("budget") - given)
        .withColumn("open", F.sum("weight").over(everything) - gone)
        .withColumn("capped", F.col("left") * F.col("weight") > F.col("cap") * F.col("open"))
    )
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    level = (left * F.col("weight")).cast("double") / open_weight.cast("double")
    return shared.select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level).alias("target"),
        "budget",
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    on = F.lit(True)
    for name in names:
        on = on & left[name].eqNullSafe(right[name])
    return on


def _before(histogram: DataFrame, bucket: str, *by: str) -> DataFrame:
    """Words in earlier buckets, beside each bucket of a histogram."""
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return histogram.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))


def cuts(sizes: DataFrame, shares: DataFrame, epochs: int = 3, rows_per_bucket: int = 10_000) -> DataFrame:
    """Where each source's part of the mix ends: ``source, source_size, target, epoch, last``.

    A document is taken ``epoch`` times, and once more if its place is not after
    ``last``. Running sums are split: words of whole buckets are summed by
    a histogram, and only the rows of one bucket are put in order in one task, about
    ``rows_per_bucket`` of them however large the hottest source is.
    """
    buckets = max(256, -(-sizes.count() // rows_per_bucket))
    width = -(-_KEYS // buckets)
    rows = sizes.withColumn("bucket", F.expr(f"place div {width}L"))
    histogram = _before(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "bucket", "source")
    histogram = stage(histogram.select("source", "bucket", "before"), "mix-places")
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.join(histogram, _same(rows, histogram, "source", "bucket")).select(
        rows["source"], rows["bucket"], "place", "doc_id", "size", "before"
    )
    run = placed.select("source", "place", "doc_id", "size", (F.col("before") + F.sum("size").over(inside)).alias("run"))

    timed = run.join(shares, _same(run, shares, "source")).select(
        run["source"], "place", "doc_id", "size", "run", "source_size", "target", "budget",
        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"),
    )
    finish = (F.col("epoch") * F.col("source_size") + F.col("run")).cast("double") / F.col("target")
    timed = timed.withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0)))
    # The mix ends soon after time 1, when every source has given its target.
    timed = timed.withColumn("slot", F.least(F.floor(F.col("finish") * buckets), F.lit(2 * buckets)))
    timed = stage(timed.select("source", "place", "doc_id", "size", "epoch", "finish", "slot", "budget"), "mix-times")

    slots = _before(timed.groupBy("slot").agg(F.sum("size").alias("words"), F.first("budget").alias("budget")), "slot")
    slots = stage(slots.withColumn("whole", F.col("before") + F.col("words") <= F.col("budget")), "mix-slots")
    marked = timed.join(slots.select("slot", "before", "whole"), "slot")
    order = (
        Window.partitionBy("slot")
        .orderBy("finish", "place", "doc_id", F.col("source").asc_nulls_last(), "size", "epoch")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edge = (
        marked.filter(~F.col("whole") & (F.col("before") <= F.col("budget")))
        .withColumn("total", F.col("before") + F.sum("size").over(order))
        .filter(F.col("total") <= F.col("budget"))
    )
    taken = marked.filter("whole").select("source", "epoch", "place").unionByName(edge.select("source", "epoch", "place"))
    # In one source the order by time is the order by epoch and place, so its part is all up to its last copy.
    ends = taken.groupBy("source").agg(F.max("epoch").alias("epoch"), F.max_by("place", F.struct("epoch", "place")).alias("last"))
    return shares.join(ends, _same(shares, ends, "source"), "left").select(
        shares["source"], "source_size", "target",
        F.coalesce("epoch", F.lit(0)).alias("epoch"), F.coalesce("last", F.lit(-1)).alias("last"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    epochs: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Sizes and places of all documents, and the cut of every source; see ``copies``.

    Runs jobs: words are counted once, sizes and times are written once.
    """
    sizes = stage(sized(docs, doc_id, text, source), "mix-sizes")
    shares = stage(targets(sizes, weights, epochs), "mix-targets")
    return sizes, stage(cuts(sizes, shares, epochs), "mix-cuts")


def copies(of: Column, epoch: Column, last: Column) -> Column:
    """How often the mix takes a document that stands at a place."""
    return epoch + F.when(of <= last, F.lit(1)).otherwise(F.lit(0))


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; ``taken`` counts repeats."""
    rows, ends = mix(docs, **options)
    return rows.join(ends, _same(rows, ends, "source")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * copies(F.col("place"), F.col("epoch"), F.col("last"))).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as often as they are taken, all columns kept.

    Texts are not shuffled: a row is kept by its own place and the cut of its source.
    """
    _, ends = mix(docs, **options)
    ends = ends.select(
        F.col("source").alias("_mix_source"), F.col("epoch").alias("_mix_epoch"), F.col("last").alias("_mix_last")
    )
    doc_id, text, source = (options.get(k, k) for k in ("doc_id", "text", "source"))
    rows = docs.withColumn("_mix_place", place(F.col(doc_id), words(F.col(text)), F.col(text)))
    times = copies(F.col("_mix_place"), F.col("_mix_epoch"), F.col("_mix_last"))
    kept = rows.join(ends, rows[source].eqNullSafe(ends["_mix_source"])).withColumn("_mix_times", times)
    return (
        kept.filter("_mix_times > 0")
        .withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), F.col("_mix_times").cast("int"))))
        .select(*[docs[c] for c in docs.columns])
    )
