"""Small helpers shared by the training-data operators.

``Scratch`` writes intermediate tables below the session's
``spark.checkpoint.dir`` (shared storage on a cluster) and reads them back, so
a lost executor never costs more than the step that was running. They go when
the process ends, those of a finished step before.
"""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import scratch_path

#: Text bytes that one Python step handles at a time, inside one Arrow batch.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch on its way to a Python worker, about, in sessions that set no limit of their own (Spark's is
#: 64 MB). Every task has a batch twice: in the executor's JVM, outside its heap, and in the worker.
BATCH_BYTES = 2 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package also when it is not installed, and get batches of bounded bytes.

    Only the worker's search path of this application is extended; on a cluster
    install the package or pass it with ``--py-files``.
    """
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _PACKAGE_ROOT])
    return spark


class Scratch:
    """Intermediate Parquet tables of one operator run, in a folder of its own."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = ready(spark)
        self.root = scratch_path(spark, f"llm-{tag}")
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Write ``df`` and read it back: its lineage ends here."""
        path = self.path(name)
        df.write.parquet(path, compression=compression)
        return self.read(path, df.schema)

    def read(self, path: str, schema) -> DataFrame:
        out = self.spark.read.schema(schema).parquet(path)
        out.scratch_path = path
        return out

    def finish(self, df: DataFrame) -> DataFrame:
        """Write the result of the run to a place of its own and delete all its intermediate tables."""
        out = Scratch(self.spark, "result").table(df, "rows")
        self._delete(self.root)
        return out

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, df: DataFrame) -> None:
        """Delete a table of this run that nothing reads any more."""
        path = getattr(df, "scratch_path", None)
        if path and path.startswith(self.root):
            self._delete(path)


def tidy(step):
    """A step over Arrow batches that hands unused memory back to the system when its task ends.

    Python workers are reused; what the allocators keep from one task would count against the next.
    """
    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim is not None:
                trim(0)
    return run


def crc_mod(doc_id, mod: int):
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    as_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % F.lit(mod)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of ``column`` each (one row at least)."""
    col = batch.column(column)
    n = batch.num_rows
    if n == 0:
        return
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    off = np.frombuffer(col.buffers()[1], dtype=kind, count=n + 1 + col.offset)[col.offset:]
    off = off.astype(np.int64)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(off, off[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), n)
        yield batch.slice(begin, end - begin)
        begin = end


def as_bytes(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return col.cast(pa.binary()).to_pylist()


#: 64-bit odd multipliers and shifts of the finaliser (fixed values).
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    a, b, s = _MIX
    x = x ^ (x >> s)
    x = x * a
    x = x ^ (x >> s)
    x = x * b
    return x ^ (x >> s)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
