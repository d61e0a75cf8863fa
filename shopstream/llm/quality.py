"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of label 1; everything else is learned from
unlabelled text of the corpus. Negative labels are never used. A linear
model minimises the non-negative unbiased risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

where R_p and R_u are mean logistic losses over positives and unlabelled rows.
The class prior (the positives' share of unlabelled text) is estimated first:
a plain positive-versus-unlabelled model is fitted on half of the sample, and on
the other half the smallest ratio of the two sets' upper tails, with a
confidence term, bounds the share (best-bin estimation).

Features are made from the whole text: a hashed histogram of byte pairs (square
roots of frequencies) and some shape statistics. Fitting runs in one task on a
bounded, documented sample (``n_positive`` and ``n_unlabelled`` rows by a hash of
``doc_id``); scoring maps over all documents and shuffles nothing.

Defined cases: null text counts as empty and gets the score of empty text;
null labels and labels other than 1 are not learned; documents labelled twice
count once; without positives every score is 0.5; equal texts score alike;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_bytes, crc_mod, ready, slices, tidy
from shopstream.llm.training import BROADCAST_ROWS, fit_in_one_task, sample_by_class, sample_rows, training_rows

PAIR_BUCKETS = 512
SHAPES = 12
N_POSITIVE = 8000
N_UNLABELLED = 8000
STEPS = 400
RATE = 0.05
DECAY = 1e-3
HELD_MOD, HELD = 3, 1

_CLASS = np.zeros(256, np.uint8)  # 0 other, then: lower, upper, digit, space, mark, above ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5
_CLASS[128:] = 6
_pairs = np.arange(1 << 16, dtype=np.uint32) * np.uint32(2654435769)
_PAIR_BUCKET = (_pairs >> np.uint32(32 - 9)).astype(np.int32)


def text_features(texts: list[bytes]) -> np.ndarray:
    """A row of PAIR_BUCKETS + SHAPES numbers for each text."""
    n = len(texts)
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(n), size)
    out = np.zeros((n, PAIR_BUCKETS + SHAPES), np.float32)
    length = np.maximum(size, 1)
    if len(data) > 1:
        pair = _PAIR_BUCKET[(data[:-1].astype(np.int32) << 8) | data[1:]]
        inside = doc[1:] == doc[:-1]
        count = np.bincount((doc[1:] * PAIR_BUCKETS + pair)[inside], minlength=n * PAIR_BUCKETS)
        out[:, :PAIR_BUCKETS] = np.sqrt(count.reshape(n, -1) / length[:, None])
    kinds = np.bincount(doc * 7 + _CLASS[data], minlength=n * 7).reshape(n, 7) / length[:, None]
    out[:, PAIR_BUCKETS:PAIR_BUCKETS + 7] = kinds
    for i, t in enumerate(texts):
        words, lines = t.split(), t.split(b"\n")
        out[i, PAIR_BUCKETS + 7:] = (
            np.log1p(size[i]) / 10, np.log1p(len(words)) / 10, min(size[i] / max(len(words), 1), 40.0) / 40,
            len(set(words)) / max(len(words), 1), len(set(lines)) / len(lines))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _adam(grad, size: int, steps: int) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = grad(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _penalty(w: np.ndarray) -> np.ndarray:
    d = DECAY * w
    d[-1] = 0.0
    return d


def positive_vs_unlabelled(p: np.ndarray, u: np.ndarray, steps: int = STEPS // 2) -> np.ndarray:
    def grad(w):
        return (-(p.T @ _sigmoid(-(p @ w))) / len(p) + u.T @ _sigmoid(u @ w) / len(u)) / 2 + _penalty(w)
    return _adam(grad, p.shape[1], steps)


def estimate_prior(p_score: np.ndarray, u_score: np.ndarray, delta: float = 0.1) -> float:
    """The positives' share of the unlabelled rows, from scores of rows not fitted on."""
    cuts = np.unique(p_score)
    tail_p = 1 - np.searchsorted(np.sort(p_score), cuts) / len(p_score)
    tail_u = 1 - np.searchsorted(np.sort(u_score), cuts) / len(u_score)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(p_score)) + 1 / np.sqrt(len(u_score)))
    best = np.argmin((tail_u + slack) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.01, 0.99))


def non_negative_risk_fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    def grad(w):
        zp, zu = p @ w, u @ w
        # Slopes of the mean logistic losses.
        plus_p = -(p.T @ _sigmoid(-zp)) / len(p)
        minus_p = (p.T @ _sigmoid(zp)) / len(p)
        minus_u = (u.T @ _sigmoid(zu)) / len(u)
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if rest >= 0:
            return prior * plus_p + minus_u - prior * minus_p + _penalty(w)
        return -(minus_u - prior * minus_p) + _penalty(w)  # step back until the negative risk is possible again
    return _adam(grad, p.shape[1], steps)


def _fit(sample: pa.Table) -> pa.RecordBatch:
    ids = np.array([i if i is not None else -1 for i in sample["doc_id"].to_pylist()])
    label = sample["label"].to_numpy()
    order = np.lexsort((label, ids))
    sample, label = sample.take(pa.array(order)), label[order]
    x = np.concatenate([text_features([t or b"" for t in as_bytes(part.column("text"))])
                        for batch in sample.combine_chunks().to_batches() for part in slices(batch, "text")])
    p, u = x[label == 1].astype(np.float64), x[label == 0].astype(np.float64)
    if not len(p) or not len(u):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64())], names=["i", "w"])
    mean, spread = u.mean(axis=0), u.std(axis=0) + 1e-3
    scale = lambda m: np.hstack([(m - mean) / spread, np.ones((len(m), 1))])
    p, u = scale(p), scale(u)
    w = positive_vs_unlabelled(p[::2], u[::2])
    rest_p, rest_u = (p[1::2] if len(p) > 1 else p), (u[1::2] if len(u) > 1 else u)
    prior = estimate_prior(rest_p @ w, rest_u @ w)
    w = non_negative_risk_fit(p, u, prior)
    # Undo the scaling: the model applies to raw features.
    raw = np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(raw) + 1, dtype=np.int32)), pa.array(np.append(raw, prior))],
                                      names=["i", "w"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", n_positive: int = N_POSITIVE,
          n_unlabelled: int = N_UNLABELLED) -> tuple[np.ndarray | None, float]:
    """Weights over raw features (bias last) and the estimated class prior."""
    ready(docs.sparkSession)
    known = training_rows(labels, HELD_MOD, HELD)
    positive = sample_by_class(known.where(F.col(label) == 1).select("doc_id", F.lit(1).alias("label")), docs, n_positive) \
        .select("doc_id", "text", F.lit(1).alias("label"))
    pool = training_rows(docs.select("doc_id", "text"), HELD_MOD, HELD)
    marked = labels.where(F.col(label).isNotNull()).select("doc_id").distinct()
    free = pool.join(marked, "doc_id", "left_anti")
    if free.select("doc_id").isEmpty():
        free = pool
    ids = sample_rows(free.select("doc_id"), n_unlabelled)
    if n_unlabelled <= BROADCAST_ROWS:
        ids = F.broadcast(ids)  # about n_unlabelled ids
    unlabelled = pool.join(ids, "doc_id", "left_semi").select("doc_id", "text", F.lit(0).alias("label"))
    sample = positive.unionByName(unlabelled).withColumn("text", F.coalesce("text", F.lit("")))
    rows = sorted((r.i, r.w) for r in fit_in_one_task(sample, _fit, "i int, w double").collect())
    if not rows:
        return None, float("nan")
    w = np.array([x for _, x in rows])
    return w[:-1], float(w[-1])


def score(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                if weights is None:
                    p = np.full(part.num_rows, 0.5)
                else:
                    x = text_features([t or b"" for t in as_bytes(part.column("text"))])
                    p = _sigmoid(x @ weights[:-1] + weights[-1])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(p)],
                                                 names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (crc_mod(F.col("doc_id"), HELD_MOD) == HELD).alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
