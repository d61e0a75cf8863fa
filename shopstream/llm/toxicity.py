"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashed words, word pairs and pairs with
one word between them. Weights are learned one document at a time with a
learning rate for each coordinate; the L1 term keeps most weights at exactly
zero, so the model is a short list of (bucket, weight) that every task holds.
Scoring reads whole texts and shuffles nothing.

The model is fitted in one task on a bounded, documented sample of labelled
rows: ``per_class`` rows of each class, chosen by a hash of ``doc_id`` and
weighted back to the labels' own proportions.

Defined cases: null and empty texts score as the bias alone; null labels are
not learned; a document labelled more than once counts once, as toxic if any
row says so; without labels every score is 0; equal texts score alike; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_bytes, crc_mod, mix64, ready, slices, tidy
from shopstream.llm.decontamination import words_of
from shopstream.llm.training import fit_in_one_task, sample_by_class, training_rows

BITS = 20
PER_CLASS = 8000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 5.0, 1.0, 5.0, 0.01
HELD_MOD, HELD = 4, 2
THRESHOLD = 0.3

_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def hashed_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs, in order of text."""
    words = [words_of(t) for t in texts]
    size = np.array([len(w) for w in words])
    h = mix64(np.fromiter((zlib.crc32(x) for w in words for x in w), np.uint64, int(size.sum())))
    doc = np.repeat(np.arange(len(texts)), size)
    docs, keys = [doc], [mix64(h + _SALTS[0])]
    for gap, salt in ((1, _SALTS[1]), (2, _SALTS[2])):
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        pair = mix64(h[:-gap] * salt + h[gap:]) if len(doc) > gap else np.zeros(0, np.uint64)
        docs.append(doc[gap:][same] if len(doc) > gap else doc[:0])
        keys.append(pair[same])
    return np.concatenate(docs), (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.unique((doc << BITS) | bucket)
    return code >> BITS, code & ((1 << BITS) - 1)


def ftrl(rows: list[tuple[np.ndarray, float, float]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias from (buckets, label, weight) rows, in the given order."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias
    for _ in range(epochs):
        for buckets, label, weight in rows:
            at = np.append(buckets, size)
            w = _weights(z[at], n[at])
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = (p - label) * weight
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = _weights(z, n)
    return w[:-1], float(w[-1])


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    keep = np.abs(z) > L1
    return np.where(keep, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def _fit(sample: pa.Table) -> pa.RecordBatch:
    order = np.argsort(np.array([zlib.crc32(str(i).encode()) for i in sample["doc_id"].to_pylist()]), kind="stable")
    sample = sample.take(pa.array(order))
    rows = []
    for batch in sample.combine_chunks().to_batches():
        for part in slices(batch, "text"):
            doc, bucket = _distinct(*hashed_features([t or b"" for t in as_bytes(part.column("text"))]))
            cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
            weight = part.column("weight").to_numpy(zero_copy_only=False)
            label = part.column("label").to_numpy(zero_copy_only=False)
            rows += [(bucket[cut[i]:cut[i + 1]], float(label[i]), float(weight[i])) for i in range(part.num_rows)]
    mean = np.mean([r[2] for r in rows])
    w, bias = ftrl([(b, y, k / mean) for b, y, k in rows])
    at = np.flatnonzero(w)
    return pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))],
                                      names=["bucket", "w"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> list[tuple[int, float]]:
    """The non-zero weights; bucket -1 is the bias."""
    ready(docs.sparkSession)
    labelled = training_rows(labels, HELD_MOD, HELD).select("doc_id", F.col(label).alias("label"))
    sample = sample_by_class(labelled, docs, per_class)
    sample = sample.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"),
                           F.col("label").cast("double").alias("label"), "weight")
    return [(r.bucket, r.w) for r in fit_in_one_task(sample, _fit, "bucket long, w double").collect()]


def score(docs: DataFrame, model: list[tuple[int, float]], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    spark = ready(docs.sparkSession)
    bias = dict(model).get(-1)
    shared = spark.sparkContext.broadcast(model)  # a weight for each non-zero bucket, at most 2 ** BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS)
        for b, w in shared.value:
            if b >= 0:
                weights[b] = w
        for batch in batches:
            for part in slices(batch, "text"):
                doc, bucket = hashed_features([t or b"" for t in as_bytes(part.column("text"))])
                live = weights[bucket] != 0
                doc, bucket = _distinct(doc[live], bucket[live])
                z = np.bincount(doc, weights=weights[bucket], minlength=part.num_rows) + (bias or 0.0)
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) if bias is not None else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(p)],
                                                 names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (crc_mod(F.col("doc_id"), HELD_MOD) == HELD).alias("held_out"),
                       F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))
