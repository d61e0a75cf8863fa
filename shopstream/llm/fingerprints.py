"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (non-empty lines). Every paragraph is
hashed to a wide vector and the vectors are added, lane by lane, modulo powers of
two. The sum does not depend on the order of paragraphs, and inserting or deleting
one adds or subtracts its vector, so an edited document's fingerprint follows
from the old one and the paragraphs that changed.

The vector has two parts:

* ``HASH_LANES`` lanes modulo 2^64 from SHAKE-128 of the paragraph's bytes: equal
  multisets have equal sums, others differ but for a negligible chance;
* ``LIKE_LANES`` lanes modulo 2^32: each shingle of ``SHINGLE`` words inside the
  paragraph adds +1 or -1 to one lane. Their sums, read as signed numbers, give
  the likeness of two texts: the cosine, which estimates that of their shingle
  counts with an error of about 1 / sqrt(LIKE_LANES).

The fingerprint is the lanes' hex digits, big-endian, hash lanes first.

``edited_fingerprints`` pairs each document with the next by ``doc_id``. Bounds
are drawn from a sample of the ids; bucket j gets the ids from bound j up to the
next, and the document at a bound is also sent to the bucket before, so that
a task sees each document's follower. Texts are shuffled once, and each
document's edit is applied to its sums incrementally.

Defined cases: null text is empty; a text without paragraphs has the zero
fingerprint; two zero fingerprints have likeness 1, one zero and another 0; null
``doc_id`` sorts first; equal ids are ordered by a hash of their text; a single
document's follower is itself; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import mix64, ready, tidy
from shopstream.llm.words import word_spans

HASH_LANES = 16
LIKE_LANES = 128
SHINGLE = 3
#: Sampled ids for each bucket bound.
SAMPLE = 50

_TURN = np.array([1, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], np.uint64)
_LOWEST = -(1 << 63)


def _paragraph_hash(p: str) -> bytes:
    return hashlib.shake_128(p.encode()).digest(8 * HASH_LANES) if p else bytes(8 * HASH_LANES)


class Paragraphs:
    """A text's paragraph vectors, ready to be summed over any range of paragraphs."""

    def __init__(self, text: str):
        self.text = text
        self.lines = text.split("\n")
        self.hashes = np.frombuffer(b"".join(map(_paragraph_hash, self.lines)), ">u8").reshape(-1, HASH_LANES)
        self.line_of, self.lane, self.sign = _shingles(text)

    def sums(self, begin: int = 0, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Both parts of the sum over paragraphs ``begin`` to ``end``."""
        end = len(self.lines) if end is None else end
        a, b = np.searchsorted(self.line_of, [begin, end])
        like = np.bincount(self.lane[a:b], weights=self.sign[a:b], minlength=LIKE_LANES)
        return self.hashes[begin:end].sum(axis=0, dtype=np.uint64), like.astype(np.int64)


def _shingles(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line number (ascending), lane and sign of each shingle; a line of fewer words is one shingle."""
    data, start, _, h = word_spans(text.encode())
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    line = np.searchsorted(np.flatnonzero(data == 10), start)
    n = len(h)
    tail = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    next_line = np.concatenate([line, np.full(SHINGLE, -1)])
    first = np.append(True, line[1:] != line[:-1])
    mixed, whole = h * _TURN[0], np.ones(n, bool)
    for i in range(1, SHINGLE):
        same = next_line[i:i + n] == line
        mixed = mixed + np.where(same, tail[i:i + n] * _TURN[i], np.uint64(0))
        whole &= same
    keep = whole | first  # a short line's first word stands for all of it
    t = mix64(mixed[keep] + np.uint64(1))
    return line[keep], (t >> np.uint64(57)).astype(np.int64), (t & np.uint64(1)).astype(np.float64) * 2 - 1


def fingerprint_hex(hash_part: np.ndarray, like_part: np.ndarray) -> str:
    like = (like_part & 0xFFFFFFFF).astype(">u4")
    return hash_part.astype(">u8").tobytes().hex() + like.tobytes().hex()


def fingerprint(text: str | None) -> str:
    """The fingerprint of one text."""
    return fingerprint_hex(*Paragraphs(text or "").sums())


def _parts(fp: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fp)
    return (np.frombuffer(raw[:8 * HASH_LANES], ">u8").astype(np.uint64),
            np.frombuffer(raw[8 * HASH_LANES:], ">u4").astype(np.uint32))


def combine(fp: str, other: str, sign: int = 1) -> str:
    """Fingerprint of the union of two texts' paragraphs, or (``sign`` -1) of the first without the second's."""
    (a, x), (b, y) = _parts(fp), _parts(other)
    if sign < 0:
        return fingerprint_hex(a - b, (x - y).astype(np.int64))
    return fingerprint_hex(a + b, (x + y).astype(np.int64))


def insert_paragraph(fp: str, paragraph: str) -> str:
    return combine(fp, fingerprint(paragraph))


def delete_paragraph(fp: str, paragraph: str) -> str:
    return combine(fp, fingerprint(paragraph), -1)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1 from two sums (hash part, signed like part)."""
    if np.array_equal(a[0], b[0]):
        return 1.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    size = float(np.sqrt((x @ x) * (y @ y)))
    return float(min(1.0, max(0.0, (x @ y) / size))) if size else 0.0


def edit(doc: Paragraphs, following: Paragraphs) -> tuple[str, tuple[np.ndarray, np.ndarray]]:
    """The edited text and its sums: paragraphs that stay are not hashed again."""
    n = len(doc.text)
    head = following.text[:n // 2]
    kept = doc.text[:n - n // 2]
    whole = kept.count("\n")  # paragraphs of the document that stay whole
    pieces = head.split("\n")
    border = kept[kept.rfind("\n") + 1:] + pieces[0]
    changed = [border] if len(pieces) == 1 else [border, pieces[-1]]
    sums = [doc.sums(0, whole), following.sums(1, max(1, len(pieces) - 1)), *(Paragraphs(p).sums() for p in changed)]
    return kept + head, (sum(s[0] for s in sums), sum(s[1] for s in sums))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _row(doc_id, doc: Paragraphs, following: Paragraphs) -> dict:
    own, after = doc.sums(), following.sums()
    text, changed = edit(doc, following)
    return {"doc_id": doc_id, "n_chars": len(doc.text), "edited_sha256": hashlib.sha256(text.encode()).hexdigest(),
            "fingerprint": fingerprint_hex(*own), "edited_fingerprint": fingerprint_hex(*changed),
            "near_edited": likeness(own, changed), "near_next": likeness(own, after)}


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, own documents first, then those that only follow (the next bucket's first, or the table's)."""
    held, done = None, False
    rows: list[dict] = []
    for batch in batches:
        for doc_id, text, guest in zip(*(batch.column(c) for c in ("doc_id", "text", "guest"))):
            if done:
                break
            now = Paragraphs(text.as_py())
            if held is not None:
                rows.append(_row(held[0], held[1], now))
            held, done = (doc_id.as_py(), now), guest.as_py() > 0
            if len(rows) >= 500:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                rows = []
    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    spark = ready(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST))
    ids = docs.select(key.alias("k"))
    r = ids.agg(F.count("*").alias("n"), F.min("k").alias("low")).first()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Bounds are ids of the table: about SAMPLE for each bucket come to the driver.
    rate = min(1.0, SAMPLE * parts / max(r.n, 1))
    drawn = ids.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30))))
    seen = np.unique(np.array([x.k for x in drawn.collect()], np.int64))
    seen = seen[seen > r.low] if r.n else seen
    bounds = seen[np.unique(np.linspace(0, len(seen) - 1, min(parts, len(seen) + 1) + 1).astype(int)[1:-1])] \
        if len(seen) else seen
    last = len(bounds)

    @F.arrow_udf("int")
    def bucket(k: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       key.alias("k")).withColumn("bucket", bucket("k"))

    @F.arrow_udf("boolean")
    def is_bound(k: pa.Array) -> pa.Array:
        return pa.array(np.isin(k.to_numpy(), bounds))

    target = lambda b, g: F.struct(b.cast("int").alias("bucket"), F.lit(g).alias("guest"))
    sent = F.array_compact(F.array(
        target(F.col("bucket"), 0), F.when(is_bound("k"), target(F.col("bucket") - 1, 1)),
        F.when(F.col("k") == F.lit(r.low), target(F.lit(last), 2))))
    rows = rows.withColumn("to", F.explode(sent)) \
        .select("doc_id", "text", "k", F.col("to.bucket").alias("bucket"), F.col("to.guest").alias("guest"))
    return rows.repartitionById(last + 1, F.col("bucket")) \
        .sortWithinPartitions("guest", "k", F.xxhash64("text")).select("doc_id", "text", "guest") \
        .mapInArrow(tidy(_follow), SCHEMA)
