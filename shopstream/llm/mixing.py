"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the training span [0, 1], a straight
line from ``start`` to ``end`` times its weight, whose mean is the weight. The
schedule's integral is the source's share; shares become word targets, which
stop at ``max_repeats`` times the source's size (the excess goes to the other
sources by weight, until none is above its limit).

A source's documents stand in a fixed hash order and are read pass after pass.
The words before a copy's middle word, all passes before included, are exact: those
before its hash bucket plus a running sum inside the bucket. A copy's training
position is the time by which the schedule has demanded these words, the inverse of
the source's cumulative demand (the integral of its schedule). Demand ends at the
target: a copy whose middle word lies beyond it has no position and is not taken.
So a source misses its target by about half a document, and no document is
taken more than ``max_repeats`` times. Sorting by position gives the training order.

Sums move, and a small row for each document: (source, hash, words) by hash bucket, and the
positions back to the document. No source, hot or not, is gathered in a task. ``mix_documents``
shuffles texts twice, to their positions and by them; ``mixed_words`` writes that mix and counts in it.

Defined cases: null text has size 0; a null source is a source, the last;
documents of size 0 are taken like their neighbours and count 0 words, and
those of a source without words are not taken; rows with equal ``doc_id`` in a source
share one hash and one place (the middle of the largest of them, as the last) and are taken
alike; an empty table gives an empty result; ``mix_documents`` keeps all columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch

#: Weights by rank of the source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Schedules by rank of the source, repeating: factors of the weight at the start and at the end.
SCHEDULES = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))
MAX_REPEATS = 3
#: Documents for one hash bucket of a source, about.
BUCKET_ROWS = 5_000

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(doc_id: Column) -> Column:
    """The document's place in its source's order, as text of hex digits."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def _slot(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def _bucket(h: Column, n_docs: Column, bucket_rows: int) -> Column:
    n_buckets = F.ceil(n_docs / F.lit(bucket_rows))
    return F.floor(_slot(h) * n_buckets / F.lit(float(1 << 32))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int, scratch: Scratch) -> DataFrame:
    """(source, source_size, n_docs, rank, target) from per-source sums.

    Ranks come from ranges by code point and a count for each range. The level
    (words for each unit of weight) rises until the sources at their limit are
    known; each step sends three sums to the driver.
    """
    order = F.col("source").asc_nulls_last()
    ranged = scratch.table(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    base = ranged.groupBy("part").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")  # a row for each range
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    ranked = ranged.withColumn("rank", rank).join(base, "part").withColumn("rank", (F.col("rank") + F.col("base")))
    pick = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(pick, (F.col("rank") % len(weights) + 1).cast("int"))
    table = scratch.table(ranked.select(
        "source", "source_size", "n_docs", F.col("rank").cast("long").alias("rank"), weight.alias("weight"),
        (F.col("source_size") * max_repeats).cast("double").alias("cap")), "weights")
    total = table.agg(F.sum("source_size").alias("t")).first().t or 0
    level, capped = 0.0, None
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        r = table.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("full"),
                      F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.sum(above.cast("int")).alias("n")).first()
        if r.n == capped or not r.open:
            break
        capped, level = r.n, (total - r.full) / r.open
    return table.select("source", "source_size", "n_docs", "rank",
                        F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def document_sizes(docs: DataFrame, weights: Sequence[float], max_repeats: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes (doc_id, source, size, h), and for each source
    (source, source_size, n_docs, rank, target)."""
    rows = scratch.table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                     order_hash(F.col("doc_id")).alias("h")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    return rows, scratch.table(source_targets(sizes, weights, max_repeats, scratch), "targets")


def training_places(rows: DataFrame, targets: DataFrame, max_repeats: int, schedules: Sequence[tuple[float, float]],
                    bucket_rows: int, scratch: Scratch) -> DataFrame:
    """(rank, h, positions) of the documents of each source: the training position of each copy taken."""
    side = targets.select(F.col("source").alias("s"), "rank", "n_docs")
    placed = rows.join(side, rows["source"].eqNullSafe(side["s"])) \
        .withColumn("bucket", _bucket(F.col("h"), F.col("n_docs"), bucket_rows)) \
        .groupBy("rank", "bucket", "h").agg(F.sum("size").alias("words"), F.max("size").alias("largest"))
    upto = Window.partitionBy("rank", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = scratch.table(placed.withColumn("upto", F.sum("words").over(upto)), "places")
    sums = placed.groupBy("rank", "bucket").agg(F.sum("words").alias("words"))
    run = Window.partitionBy("rank").orderBy("bucket")  # a row for each bucket
    base = sums.select(F.col("rank").alias("r"), F.col("bucket").alias("b"), (F.sum("words").over(
        run.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")).alias("base"))
    # Equal hashes are taken alike: where the last and largest of them ends decides.
    middle = F.col("base") + F.col("upto") - F.col("largest") / F.lit(2.0)
    per_source = targets.select(F.col("rank").alias("of"), "source_size", "target")

    def position(k: int) -> Column:
        words = F.lit(k) * F.col("source_size") + middle
        # The partial pass ends before the target; whole passes end with the source.
        met = (words < F.col("target")) | (F.lit(k + 1) * F.col("source_size") <= F.col("target"))
        share = F.least(words / F.col("target"), F.lit(1.0))
        return F.when((F.col("source_size") > 0) & met, training_position(share, F.col("rank"), schedules))

    return placed.join(base, (F.col("rank") == F.col("r")) & (F.col("bucket") == F.col("b"))) \
        .join(per_source, F.col("rank") == F.col("of")) \
        .select("rank", "h", F.filter(F.array(*[position(k) for k in range(max_repeats)]), lambda p: p.isNotNull()).alias("positions"))


def mixing_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                bucket_rows: int = BUCKET_ROWS, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes (doc_id, source, size, h), and for each source (source, source_size, rank, target,
    passes, boundary): whole passes, and the first hash that the partial pass does not take (null: it takes all)."""
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    rows, targets = document_sizes(docs, weights, max_repeats, scratch)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("passes", passes.cast("int"))
    places = training_places(rows, targets, max_repeats, SCHEDULES, bucket_rows, scratch).withColumnRenamed("rank", "r")
    bounds = places.join(targets, F.col("rank") == F.col("r")).where(F.size("positions") <= F.col("passes")) \
        .groupBy("r").agg(F.min("h").alias("boundary"))
    plan = targets.join(bounds, F.col("rank") == F.col("r"), "left") \
        .select("source", "source_size", "rank", "target", "passes", "boundary")
    return rows, scratch.table(plan, "plan")


def taken_words(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                schedules: Sequence[tuple[float, float]] = SCHEDULES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of each document."""
    return training_positions(docs, weights, max_repeats, schedules) \
        .withColumn("copies", F.size("positions")) \
        .select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def training_positions(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                       schedules: Sequence[tuple[float, float]] = SCHEDULES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, positions) of each document: when in training, from 0 to 1,
    each of its copies is read."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, targets = document_sizes(docs, weights, max_repeats, scratch)
    places = training_places(rows, targets, max_repeats, schedules, bucket_rows, scratch)
    side = targets.select(F.col("source").alias("s"), F.col("rank").alias("r"), "source_size", "target")
    places = places.withColumnRenamed("h", "place")
    return rows.join(side, rows["source"].eqNullSafe(side["s"])) \
        .join(places, (F.col("r") == F.col("rank")) & (F.col("h") == F.col("place"))) \
        .select("doc_id", "source", "size", "source_size", "target", "positions")


def training_position(share: Column, rank: Column, schedules: Sequence[tuple[float, float]]) -> Column:
    """The time u in [0, 1] by which ``share`` of a source's demand has been met.

    With weight a at the start and b at the end, the demand met by u is
    (a u + (b - a) u^2 / 2) / ((a + b) / 2); this is its inverse, in a form that
    also holds for a = b.
    """
    at = (rank % len(schedules) + 1).cast("int")
    a = F.element_at(F.array(*[F.lit(float(x)) for x, _ in schedules]), at)
    b = F.element_at(F.array(*[F.lit(float(y)) for _, y in schedules]), at)
    root = F.sqrt(F.greatest(a * a + (b - a) * (a + b) * share, F.lit(0.0)))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (a + b) * share / (a + root)))


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                  schedules: Sequence[tuple[float, float]] = SCHEDULES) -> DataFrame:
    """The mix: a row of ``docs`` for each copy taken, range-sorted by training position."""
    scratch = Scratch(docs.sparkSession, "mixing")
    return _mix(docs, *document_sizes(docs, weights, max_repeats, scratch), max_repeats, schedules, scratch)


def _mix(docs: DataFrame, sizes: DataFrame, targets: DataFrame, max_repeats: int, schedules: Sequence[tuple[float, float]],
         scratch: Scratch) -> DataFrame:
    cols = docs.columns
    places = training_places(sizes, targets, max_repeats, schedules, BUCKET_ROWS, scratch).withColumnRenamed("h", "place")
    side = targets.select(F.col("source").alias("s"), F.col("rank").alias("r"))
    # The caller's row travels as one struct, so its names can't meet ours.
    rows = docs.select(F.struct(*cols).alias("row"), order_hash(F.col("doc_id")).alias("h"))
    rows = rows.join(side, rows["row"]["source"].eqNullSafe(side["s"]))
    copies = rows.join(places, (F.col("r") == F.col("rank")) & (F.col("h") == F.col("place"))) \
        .select("row", "h", F.explode("positions").alias("position"))
    ordered = copies.repartitionByRange("position", "h").sortWithinPartitions("position", "h")
    return ordered.select(*[F.col("row")[c].alias(c) for c in cols])


def mixed_words(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                schedules: Sequence[tuple[float, float]] = SCHEDULES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of each document, counted in the mix itself.

    The mix is written in training order, texts and all; words and copies are those of its rows. Rows of a source with
    one ``doc_id`` and one size are taken alike, so each has an equal part of what the mix holds of them.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes, targets = document_sizes(docs, weights, max_repeats, scratch)
    mix = scratch.table(_mix(docs, sizes, targets, max_repeats, schedules, scratch), "mix", compression="zstd")
    taken = mix.select("source", order_hash(F.col("doc_id")).alias("h"), word_count(F.col("text")).alias("size"),
                       F.lit(1).alias("copy"))
    counted = taken.unionByName(sizes.select("source", "h", "size", F.lit(0).alias("copy"))) \
        .groupBy("source", "h", "size").agg(F.sum("copy").alias("copies"), F.sum(F.col("size") * F.col("copy")).alias("words"),
                                            F.sum(1 - F.col("copy")).alias("alike")) \
        .select(F.col("source").alias("of"), F.col("h").alias("place"), F.col("size").alias("length"),
                F.expr("words DIV alike").alias("taken"), F.expr("copies DIV alike").cast("int").alias("copies"))
    side = targets.select(F.col("source").alias("s"), F.col("source_size").cast("long").alias("source_size"), "target")
    return sizes.join(side, sizes["source"].eqNullSafe(side["s"])) \
        .join(counted, sizes["source"].eqNullSafe(counted["of"]) & (F.col("h") == F.col("place")) & (F.col("size") == F.col("length"))) \
        .select("doc_id", "size", "source_size", "target", "taken", "copies")
