"""Vector columns as arrays, and as canonical bytes that Spark can group and join by."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import tidy

#: Rows that one Python step handles at a time.
STEP_BYTES = 4 << 20
#: Narrowest first: a vector's bytes begin with the place of its type and are equal only for equal vectors.
_TYPES = ("<i1", "<i2", "<i4", "<i8", "<f4", "<f8")


def usable_vectors(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, values) for each length of vectors: rows without nulls and non-finite values, values in double."""
    offset = np.asarray(column.offsets, np.int64)
    size = np.diff(offset)
    values = column.values
    flat = np.asarray(values.fill_null(np.nan) if values.null_count else values, np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    use = np.asarray(column.is_valid()) & (bad[offset[1:]] == bad[offset[:-1]]) & (size > 0)
    for length in np.unique(size[use]).tolist():
        rows = np.flatnonzero(use & (size == length))
        for part in np.array_split(rows, max(1, len(rows) * length * 8 // STEP_BYTES)):
            yield part, flat[offset[part][:, None] + np.arange(length)]


def pack_rows(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest type that holds it exactly (integers for an integer array, else floats)."""
    whole = x.dtype.kind == "i"
    kinds = range(0, 4) if whole else range(4, 6)
    out: list[bytes] = [b""] * len(x)
    left = np.arange(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for kind in kinds:
            narrow = x[left].astype(_TYPES[kind])
            fits = (narrow == x[left]).all(axis=1)
            for i, row in zip(left[fits].tolist(), narrow[fits]):
                out[i] = bytes([kind]) + row.tobytes()
            left = left[~fits]
    return out


def unpack_rows(rows: list[bytes]) -> np.ndarray:
    """The vectors of equal length of ``pack_rows``: integers as int64, floats as double."""
    kinds = np.array([r[0] for r in rows], np.int64)
    wide = np.float64 if len(kinds) and kinds[0] >= 4 else np.int64
    length = (len(rows[0]) - 1) // np.dtype(_TYPES[kinds[0]]).itemsize if rows else 0
    out = np.empty((len(rows), length), wide)
    for kind in np.unique(kinds).tolist():
        at = np.flatnonzero(kinds == kind)
        out[at] = np.frombuffer(b"".join([rows[i][1:] for i in at.tolist()]), _TYPES[kind]).reshape(len(at), length)
    return out


def packed_vectors(table: DataFrame, change, columns: str) -> DataFrame:
    """(vec_id, dim, packed, *columns) of rows with a usable ``embedding``.

    ``change(values)`` gives the rows to keep, their vectors and arrays for ``columns``
    (DDL of columns after the packed vector). Other columns of ``table`` are left behind.
    """
    schema = f"vec_id long, dim int, packed binary{', ' + columns if columns else ''}"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for rows, values in usable_vectors(batch.column("embedding")):
                keep, x, *more = change(values)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(rows[keep])), pa.array(np.full(len(keep), values.shape[1], np.int32)),
                    pa.array(pack_rows(x), pa.binary()), *map(pa.array, more)], names=names)

    return table.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(tidy(run), schema)


def common_length(rows: DataFrame) -> int | None:
    """The length that most vectors have (the larger one of a tie); None if there are none."""
    top = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    return top.dim if top else None
