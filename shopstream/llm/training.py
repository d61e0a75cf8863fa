"""Bounded, repeatable training samples and one-task model fits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import crc_mod, tidy

_BITS = 30
#: Most rows (an id, a label, a number) of a sample that is broadcast.
BROADCAST_ROWS = 100_000


def _draw(doc_id: Column, seed: int) -> Column:
    """A repeatable number in [0, 1) of a document."""
    h = F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed))
    return F.shiftrightunsigned(h, 64 - _BITS) / F.lit(float(1 << _BITS))


def training_rows(docs: DataFrame, mod: int, held: int) -> DataFrame:
    """Documents whose labels may be learned: crc32 of the id modulo ``mod`` is not ``held``."""
    return docs.where(crc_mod(F.col("doc_id"), mod) != held)


def sample_by_class(labelled: DataFrame, docs: DataFrame, per_class: int, seed: int = 1) -> DataFrame:
    """(doc_id, text, label, weight): about ``per_class`` rows of each class, by a hash of the id.

    ``labelled`` is (doc_id, label); equal ids keep their largest label. ``weight`` undoes the
    sampling. The sample's ids are few (``per_class`` for each class, about) and are broadcast while
    that bound is small, so no text is shuffled to find them; the hash filter on both sides keeps
    the join small otherwise.
    """
    rows = labelled.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return docs.select("doc_id", "text", F.lit(None).cast("string").alias("label"),
                           F.lit(1.0).alias("weight")).where(F.lit(False))
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    rate = F.lit(1.0)
    for k, v in share.items():
        rate = F.when(F.col("label") == F.lit(k), F.lit(v)).otherwise(rate)
    chosen = rows.withColumn("rate", rate).where(_draw(F.col("doc_id"), seed) < F.col("rate"))
    few = docs.select("doc_id", "text").where(_draw(F.col("doc_id"), seed) < F.lit(max(share.values())))
    if per_class * len(counts) <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    return few.join(chosen, "doc_id").select("doc_id", "text", "label", (F.lit(1.0) / F.col("rate")).alias("weight"))


def sample_rows(docs: DataFrame, n: int, seed: int = 2) -> DataFrame:
    """About ``n`` documents by a hash of the id (all of them if there are fewer)."""
    total = docs.count()
    return docs.where(_draw(F.col("doc_id"), seed) < F.lit(min(1.0, n / max(total, 1))))


def fit_in_one_task(sample: DataFrame, fit: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """Hand a bounded sample to ``fit`` inside a task and return the model rows."""
    names = sample.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if parts:
            yield fit(pa.Table.from_batches(parts).select(names))

    return sample.repartition(1).mapInArrow(tidy(run), schema)
