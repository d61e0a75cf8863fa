"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

1. *Grid.* Each finite vector c becomes the integer vector x = floor(256 c).
2. *Fit list.* Each distinct x once, so copies don't weigh on the model. Its size n and
   its sums S are exact integers, summed for each task and then by Spark.
3. *Scatter.* (n x - S) / n is centred before it is multiplied; each task adds up one
   square matrix, whose rows Spark sums over tasks. Only this matrix, whose size
   is the dimension, and the components leave the distributed part.
4. *Decomposition*, in one task on that matrix: a Cholesky factor with the largest
   remaining diagonal entry as pivot, rows below their rounding error left out;
   then one-sided Jacobi rotations of the triangular factor's columns until they are
   orthogonal. Squared column norms are the eigenvalues, columns over their norms
   the components. Small eigenvalues of badly scaled data keep their digits, which a
   solver for the product would lose.
5. *Whitening* of all rows, and of the fit list to measure how far the whitened
   covariance is from the identity.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are
left out, and rows whose vector has another length than most (the longer one of a
tie); values beyond 64-bit integers count as the nearest one; a null ``vec_id`` and repeated
ids keep their rows; the larger entry of a component (the first of equals) is positive;
there are as many components as the data have directions, so none for a single distinct
vector or an empty table; ``deviation`` is null where it doesn't fit a long; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, ready, tidy
from shopstream.llm.training import fit_in_one_task
from shopstream.llm.vectors import common_length, packed_vectors, unpack_rows

SCALE = 256
COMPONENTS = 4
WHITE_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
                "identity_error double")

_EPS = np.finfo(np.float64).eps
_MOST = 2 ** 63 - 1
#: Packed vectors unpacked at a time.
_STEP = 4096


# ---------------------------------------------------------------- decomposition

def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, factor): v[order][:, order] = factor @ factor.T, factor lower trapezoidal.

    The pivot is the largest remaining diagonal entry. An entry that is only rounding
    error of its own starting value counts as zero, so that the scale of one
    dimension does not hide another's.
    """
    d = len(v)
    left, floor = v.diagonal().astype(np.float64).copy(), 16 * d * _EPS * v.diagonal()
    factor, order = np.zeros((d, d)), []
    for k in range(d):
        open_ = left > floor
        open_[order] = False
        if not open_.any():
            break
        p = int(np.argmax(np.where(open_, left, -1)))
        column = (v[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(left[p])
        column[order] = 0
        column[p] = np.sqrt(left[p])
        factor[:, k] = column
        left -= column * column
        order.append(p)
    rest = [i for i in range(d) if i not in set(order)]
    at = np.array(order + rest, np.int64)
    return at, factor[at, :len(order)]


def _rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each pair of r columns once, in rounds of disjoint pairs (a round robin)."""
    ring = list(range(r + r % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:]))]
        pairs = [(a, b) for a, b in pairs if b < r]
        out.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit columns) of factor @ factor.T, falling, by rotating the factor's columns."""
    u = factor.copy()
    rounds = _rounds(u.shape[1]) if u.shape[1] > 1 else []
    limit = max(u.shape[0], 8) * _EPS
    for _ in range(sweeps):
        moved = False
        for p, q in rounds:
            a, b = u[:, p], u[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(ab) > limit * np.sqrt(aa) * np.sqrt(bb)
            if not turn.any():
                continue
            moved = True
            p, q, a, b, aa, bb, ab = p[turn], q[turn], a[:, turn], b[:, turn], aa[turn], bb[turn], ab[turn]
            zeta = (bb - aa) / (2 * ab)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            u[:, p], u[:, q] = c * a - c * t * b, c * t * a + c * b
        if not moved:
            break
    norm = np.sqrt((u * u).sum(0))
    order = np.argsort(-norm, kind="stable")
    return norm[order] ** 2, u[:, order] / norm[order]


def components_of(v: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as rows) of a covariance, largest first, the largest entry of each positive."""
    scale = float(v.diagonal().max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((0, len(v)))
    order, factor = pivoted_cholesky(v / scale)
    values, columns = one_sided_jacobi(factor)
    out = np.empty((len(values), len(v)))
    out[:, order] = columns.T
    out *= np.where(out[np.arange(len(out)), np.argmax(np.abs(out), axis=1)] < 0, -1, 1)[:, None]
    return values[:most] * scale, out[:most]


# ---------------------------------------------------------------- Spark steps

@dataclass(frozen=True)
class Whitener:
    """A fitted model: size and sums of the fit list, trace of its covariance, components by falling eigenvalue."""
    n: int
    sums: tuple[int, ...]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit integers where they do, Python integers elsewhere."""
        most = max([self.n * int(np.abs(x).max(initial=0, where=x > -_MOST)), *map(abs, self.sums)]) * 2
        small = most < 2 ** 62 and int(x.min(initial=0)) > -_MOST
        kind = np.int64 if small else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n).astype(np.float64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """A column for each component. Every row is summed by itself, so equal vectors have equal values."""
        c = self.centred(x)
        out = [(c * w).sum(axis=1) / np.sqrt(e) for e, w in zip(self.eigenvalues, self.components)]
        return np.stack(out, axis=1) if out else np.zeros((len(x), 0))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        z = self.offsets(x)
        if z.dtype != object and (not z.size or int(np.abs(z).max()) ** 2 * z.shape[1] <= _MOST):
            return (z * z).sum(axis=1).tolist()
        total = [sum(int(a) * int(a) for a in row) for row in z]
        return [t if t <= _MOST else None for t in total]


def _grid(values: np.ndarray):
    with np.errstate(over="ignore"):
        x = np.floor(values * SCALE)
    grid = np.clip(x, -(2.0 ** 63), 2.0 ** 63 - 1024).astype(np.int64)
    grid[x >= 2.0 ** 63] = _MOST
    return np.arange(len(grid)), grid


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, _STEP):
            part = batch.slice(i, _STEP)
            yield part, unpack_rows(part.column("packed").to_pylist())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, 0
    for _, x in _vectors(batches):
        small = int(np.abs(x).max(where=x > -_MOST, initial=0)) * len(x) < 2 ** 62 and int(x.min()) > -_MOST
        total = total + (x if small else x.astype(object)).sum(axis=0).astype(object)
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
            pa.array([int(s) for s in total], pa.decimal128(38, 0))], names=["place", "n", "s"])


def _scatter(model: Whitener):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _vectors(batches):
            c = model.centred(x)
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(total)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(total), pa.int32()),
                pa.array(list(total), pa.list_(pa.float64()))], names=["place", "task", "row"])
    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the rows of each place, from batches sorted by place and task."""
    at, total = None, None
    def out():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total], pa.list_(pa.float64()))],
                                          names=["place", "row"])
    for batch in batches:
        for place, row in zip(batch.column("place").to_pylist(), batch.column("row")):
            values = row.values.to_numpy()
            if place != at:
                if at is not None:
                    yield out()
                at, total = place, values.copy()
            else:
                total += values
    if at is not None:
        yield out()


def _decompose(n: int, most: int):
    def fit(table: pa.Table) -> pa.RecordBatch:
        v = np.empty((table.num_rows, table.num_rows))
        for place, row in zip(table.column("place").to_pylist(), table.column("row").to_pylist()):
            v[place] = row
        v = (v + v.T) / (2 * n)
        values, parts = components_of(v, most)
        return pa.RecordBatch.from_arrays([
            pa.array(range(1, len(values) + 1), pa.int32()), pa.array(values), pa.array([float(v.trace())] * len(values)),
            pa.array(list(parts), pa.list_(pa.float64()))], names=["component", "eigenvalue", "trace", "vector"])
    return fit


def fit_whitener(fit_list: DataFrame, most: int = COMPONENTS) -> Whitener | None:
    """The model of a table of distinct packed vectors of one length; None for an empty one."""
    sums = fit_list.mapInArrow(tidy(_sums), "place int, n long, s decimal(38,0)") \
        .groupBy("place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("place").collect()  # a row for each dimension
    if not sums:
        return None
    start = Whitener(sums[0].n, tuple(int(r.s) for r in sums), 0.0, np.zeros(0), np.zeros((0, len(sums))))
    scatter = fit_list.mapInArrow(tidy(_scatter(start)), "place int, task int, row array<double>") \
        .repartition("place").sortWithinPartitions("place", "task").mapInArrow(tidy(_add_rows), "place int, row array<double>")
    model = fit_in_one_task(scatter, _decompose(start.n, most),
                            "component int, eigenvalue double, trace double, vector array<double>").collect()
    model.sort(key=lambda r: r.component)
    return Whitener(start.n, start.sums, model[0].trace if model else 0.0, np.array([r.eigenvalue for r in model]),
                    np.array([r.vector for r in model]).reshape(len(model), len(sums)))


def identity_error(fit_list: DataFrame, model: Whitener) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for _, x in _vectors(batches):
            n, mean, spread = _merge((n, mean, spread), _moments(model.whiten(x)))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean], pa.list_(pa.float64())),
                                              pa.array([spread.ravel()], pa.list_(pa.float64()))], names=["n", "mean", "spread"])

    parts = fit_list.mapInArrow(tidy(run), "n long, mean array<double>, spread array<double>").collect()  # a few numbers a task
    total = (0, np.zeros(k), np.zeros((k, k)))
    for r in parts:
        total = _merge(total, (r.n, np.array(r.mean), np.array(r.spread).reshape(k, k)))
    return float(np.abs(total[2] / max(total[0], 1) - np.eye(k)).max(initial=0))


def _moments(w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = w.mean(axis=0)
    return len(w), mean, (w - mean).T @ (w - mean)


def _merge(a, b) -> tuple[int, np.ndarray, np.ndarray]:
    """Size, mean and centred scatter of two lists together."""
    n = a[0] + b[0]
    if not n:
        return a
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def whitened_rows(rows: DataFrame, model: Whitener, error: float) -> DataFrame:
    """A row for each vector of ``rows`` (vec_id, packed) and component."""
    k = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace if k else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _vectors(batches):
            each, m = np.repeat(np.arange(len(x)), k), len(x) * k
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(m, model.n)), pa.array(model.deviation(x), pa.int64()).take(pa.array(each)),
                pa.array(model.whiten(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error))],
                names=[c.split()[0] for c in WHITE_SCHEMA.split(", ")])

    return rows.mapInArrow(tidy(run), WHITE_SCHEMA)


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``embeddings`` (vec_id, embedding)."""
    spark = ready(embeddings.sparkSession)
    scratch = Scratch(spark, "whitening")
    rows = scratch.table(packed_vectors(embeddings, _grid, ""), "rows")
    length = common_length(rows)
    empty = spark.createDataFrame([], WHITE_SCHEMA)
    if length is None:
        return empty
    rows = rows.where(F.col("dim") == length)
    fit_list = scratch.table(rows.select("packed").distinct(), "fit")
    model = fit_whitener(fit_list, most)
    if model is None or not len(model.eigenvalues):
        return empty
    return whitened_rows(rows.select("vec_id", "packed"), model, identity_error(fit_list, model))
