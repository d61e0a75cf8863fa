"""Nearest neighbours by inner product through a permutation index.

1. *Classes.* Equal vectors are one class with its ``k + 1`` smallest ids (no list of
   neighbours can need more), so a vector that a third of all rows hold is one entry.
2. *Pivots.* Of the ``POOL`` classes with the smallest hashes, a sample of fixed size, the
   ``PIVOTS`` that a farthest-first walk finds: a cluster of near copies gives few, as
   pivots that are alike tell other vectors apart badly. A vector is represented by
   its ``PREFIX`` nearest pivots in order. So that near means a large
   inner product, a vector x of a shard whose largest norm is M is taken as
   (x / M, sqrt(1 - |x|^2 / M^2)) for this purpose, a query as (q / |q|, 0).
3. *Shards.* Classes are dealt to shards by norm (bands of a fixed ratio, small ones
   joined, large ones cut by a hash). A shard keeps an inverted file for each pivot:
   the vectors that have it among their first pivots, and where.
4. *Search.* Distinct query vectors go to every shard in chunks. The footrule distance
   between two prefixes (a missing pivot counts as last) is P (P + 1) less twice the sum of
   P - max(place, place) over shared pivots, so adding up the inverted files of
   the query's pivots ranks the whole shard. The nearest by footrule are
   reranked by the inner product of the original vectors in double precision.
5. *Merge.* Each shard's best rows are merged for each query.

Every class is indexed and ranked; the share that is reranked falls with the square
root of the number of classes (``RERANK``), which sets the recall: measured against
brute force it is in README.

Defined cases: rows whose vector is null, empty, zero or holds null or non-finite values
take no part, nor do rows without ``vec_id`` and rows whose vector has another length
than most; of rows with one id each is a row of its own and only the query's own row
is left out; ties go to the smaller ``vec_id``; fewer than ``k`` other rows are all
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, ready, tidy
from shopstream.llm.vectors import common_length, packed_vectors, unpack_rows

K = 20
EVERY = 20
PIVOTS = 256
PREFIX = 96
POOL = 2048
#: Rows reranked for a query: RERANK * sqrt(classes), each shard its share, at least LEAST_RERANK in a shard.
RERANK = 16
LEAST_RERANK = 64
#: A shard holds about SHARD * sqrt(classes / SHARD) classes, at most SHARD_BYTES of vectors.
SHARD = 2048
SHARD_BYTES = 64 << 20
#: Norms of a band differ by at most this ratio; bands are numbered from norm 1.
BAND = 1.05
CHUNK = 512

FOUND_SCHEMA = "query long, vec_id long, class long, copy int, score double"


def norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms, also where squares overflow."""
    top = np.abs(x).max(axis=1, initial=0)
    safe = np.where(top > 0, top, 1)
    return np.sqrt(((x / safe[:, None]) ** 2).sum(axis=1)) * top


def _lifted(x: np.ndarray, norm: np.ndarray, most: float) -> np.ndarray:
    """Unit vectors of one more dimension, near a lifted query when the inner product is large."""
    share = np.minimum(norm / most, 1)
    return np.column_stack([x / norm[:, None] * share[:, None], np.sqrt(np.maximum(0, 1 - share ** 2))])


def spread_pivots(pool: np.ndarray, n: int) -> np.ndarray:
    """The first vector of the pool, then always the one whose nearest chosen direction is farthest."""
    unit = pool / norms(pool)[:, None]
    chosen, nearest = [0], unit @ unit[0]
    nearest[0] = np.inf
    while len(chosen) < min(n, len(pool)):
        i = int(np.argmin(nearest))
        chosen.append(i)
        nearest = np.maximum(nearest, unit @ unit[i])
        nearest[i] = np.inf
    return pool[chosen]


def first_pivots(lifted: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first (ties: the earlier pivot)."""
    return np.argsort(-(lifted @ pivots.T), axis=1, kind="stable")[:, :prefix]


class Shard:
    """The inverted files of one shard's vectors."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX):
        self.x = x
        self.prefix = min(prefix, len(pivots))
        norm = norms(x)
        most = float(norm.max())
        self.pivots = _lifted(pivots, norms(pivots), most)
        order = np.concatenate([first_pivots(_lifted(x[i:i + 4096], norm[i:i + 4096], most), self.pivots, self.prefix)
                                for i in range(0, len(x), 4096)]).astype(np.int32)
        flat = order.ravel()
        post = np.argsort(flat, kind="stable")
        self.begin = np.searchsorted(flat[post], np.arange(len(pivots) + 1))
        self.entry = (post // self.prefix).astype(np.int32)  # vectors of each pivot's file
        self.weight = (self.prefix - post % self.prefix).astype(np.float64)  # prefix less the place of the pivot

    def closeness(self, pivots: np.ndarray) -> np.ndarray:
        """Sum over shared pivots of prefix - max(place, place), for all vectors: high where the footrule is low."""
        files = [slice(self.begin[p], self.begin[p + 1]) for p in pivots.tolist()]
        entry = np.concatenate([self.entry[f] for f in files])
        weight = np.concatenate([np.minimum(self.weight[f], self.prefix - place) for place, f in enumerate(files)])
        return np.bincount(entry, weight, len(self.x))

    def nearest(self, q: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, scores) of the ``budget`` nearest by footrule, for each query; ties by place."""
        lifted = np.column_stack([q / norms(q)[:, None], np.zeros(len(q))])
        budget = min(budget, len(self.x))
        for vector, pivots in zip(q, first_pivots(lifted, self.pivots, self.prefix)):
            key = -self.closeness(pivots) * len(self.x) + np.arange(len(self.x))
            at = np.sort(np.argpartition(key, budget - 1)[:budget])
            with np.errstate(over="ignore", invalid="ignore"):
                yield at, (self.x[at] * vector).sum(axis=1)


def _best(at: np.ndarray, score: np.ndarray, members: np.ndarray, offset: np.ndarray, most: int):
    """The ``most`` best rows of the classes ``at``: (class place, vec_id, copy, score)."""
    score = np.where(np.isnan(score), -np.inf, score)
    if len(at) > most:
        keep = score >= np.partition(score, len(score) - most)[len(score) - most]
        at, score = at[keep], score[keep]
    size = offset[at + 1] - offset[at]
    which = np.repeat(np.arange(len(at)), size)
    copy = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    ids, value = members[offset[at][which] + copy], score[which]
    order = np.lexsort((copy, ids, -value))[:most]
    return at[which[order]], ids[order], copy[order], value[order]


def _search(pivots: np.ndarray, share: float, most: int):
    """Rows sorted by shard and kind: a shard's vectors (kind 0), then chunks of queries (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept, shard = None, [], None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            for i, number in enumerate(batch.column("shard").to_pylist()):
                if number != at:
                    at, kept, shard = number, [], None
                if kinds[i] == 0:
                    continue
                if shard is None:
                    shard = _load(kept, batch.slice(0, i), at, pivots)
                    kept = []
                if shard is not None:
                    yield _answer(shard, batch.slice(i, 1), share, most)
            if shard is None:
                kept.append(batch)
    return run


def _load(kept: list[pa.RecordBatch], last: pa.RecordBatch, number: int, pivots: np.ndarray):
    table = pa.Table.from_batches([*kept, last])
    table = table.filter(pc.equal(table.column("shard"), number)).combine_chunks()
    if not table.num_rows:
        return None
    members = table.column("members").combine_chunks()
    members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
    offset = np.asarray(members.offsets, np.int64)
    return (Shard(unpack_rows(table.column("packed").to_pylist()), pivots), table.column("class").to_numpy(),
            np.asarray(members.values, np.int64), offset)


def _answer(loaded, chunk: pa.RecordBatch, share: float, most: int) -> pa.RecordBatch:
    shard, classes, members, offset = loaded
    queries = chunk.column("members")[0].values.to_numpy()
    q = unpack_rows(chunk.column("packed_list")[0].values.to_pylist())
    budget = max(LEAST_RERANK, most, math.ceil(share * len(shard.x)))
    rows = [(np.full(len(b[0]), query), b[1], classes[b[0]], b[2], b[3])
            for query, (at, score) in zip(queries, shard.nearest(q, budget))
            for b in [_best(at, score, members, offset, most)]]
    query, ids, found, copy, score = (np.concatenate(c) for c in zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids), pa.array(found), pa.array(copy.astype(np.int32)),
                                       pa.array(score)], names=[c.split()[0] for c in FOUND_SCHEMA.split(", ")])


def _nonzero(values: np.ndarray):
    norm = norms(values)
    keep = np.flatnonzero(norm > 0)
    with np.errstate(divide="ignore"):
        band = np.rint(np.log(norm[keep]) / math.log(BAND)).astype(np.int32)
    return keep, values[keep] + 0.0, band  # no negative zeros: equal vectors have equal bytes


def deal_shards(bands: dict[int, int], size: int) -> dict[int, tuple[int, int]]:
    """(first shard, number of shards) of each band: neighbours joined up to half a shard, a large one cut."""
    out, shard, joined = {}, 0, 0
    for band in sorted(bands, reverse=True):
        n = bands[band]
        if joined and joined + n > size:
            shard, joined = shard + 1, 0
        parts = -(-n // size)
        out[band] = (shard, parts)
        joined += n
        if joined >= size / 2:
            shard, joined = shard + parts, 0
    return out


def equal_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(packed, band, members): distinct vectors and their ``most`` smallest ids in order."""
    copy = F.row_number().over(Window.partitionBy("packed").orderBy("vec_id"))
    # The filter on the row number leaves at most so many rows of a vector in a task before the shuffle.
    return rows.withColumn("copy", copy).where(F.col("copy") <= most).groupBy("packed") \
        .agg(F.first("band").alias("band"), F.sort_array(F.collect_list("vec_id")).alias("members"))


def nearest_neighbours(embeddings: DataFrame, k: int = K, every: int = EVERY, rerank: float = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each row whose ``vec_id`` is divisible by ``every``."""
    spark = ready(embeddings.sparkSession)
    scratch = Scratch(spark, "neighbours")
    rows = scratch.table(packed_vectors(embeddings.where("vec_id IS NOT NULL"), _nonzero, "band int"), "rows")
    length = common_length(rows)
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.col("dim") == length).drop("dim")
    classes = scratch.table(equal_vectors(rows, k + 1).withColumn("class", F.monotonically_increasing_id()), "classes")

    bands = {r.band: r.n for r in classes.groupBy("band").agg(F.count("*").alias("n")).collect()}  # at most 29,000
    n = sum(bands.values())
    size = min(math.ceil(SHARD * math.sqrt(max(n / SHARD, 1))), max(SHARD_BYTES // (8 * length), 1))
    dealt = deal_shards(bands, size)
    shards = 1 + max(first + parts - 1 for first, parts in dealt.values())
    places = spark.createDataFrame([(b, *p) for b, p in dealt.items()], "band int, first int, parts int")
    sharded = classes.join(F.broadcast(places), "band").withColumn(
        "shard", F.col("first") + F.pmod(F.xxhash64("packed"), F.col("parts")).cast("int"))

    pool = classes.select("packed").orderBy(F.xxhash64("packed"), "packed").limit(POOL).collect()
    pivots = spread_pivots(unpack_rows([r.packed for r in pool]), PIVOTS)
    asked = scratch.table(rows.where(F.col("vec_id") % every == 0).select("vec_id", "packed")
                          .join(classes.select("packed", "class"), "packed").select(F.col("vec_id").alias("query_id"), "class"),
                          "asked")
    queries = classes.join(asked.select("class").distinct(), "class").select("class", "packed")
    chunks = queries.mapInArrow(tidy(_chunks), "members array<long>, packed_list array<binary>")
    chunks = chunks.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                           F.lit(None).cast("long").alias("class"), F.lit(None).cast("binary").alias("packed"),
                           "members", "packed_list")
    data = sharded.select("shard", F.lit(0).alias("kind"), "class", "packed", "members",
                          F.lit(None).cast("array<binary>").alias("packed_list"))
    found = data.unionByName(chunks).repartition("shard").sortWithinPartitions("shard", "kind", F.xxhash64("packed"), "packed") \
        .mapInArrow(tidy(_search(pivots, min(1.0, rerank / math.sqrt(n)), k + 1)), FOUND_SCHEMA)

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "class", "copy"))
    best = found.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("query") \
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "class", "copy", "score"))).alias("best"))
    # The query's own row is the first of its class with its id.
    own = lambda r: (r["class"] == F.col("class")) & (r["vec_id"] == F.col("query_id"))
    first = F.array_min(F.transform(F.filter("best", own), lambda r: r["place"]))
    others = F.filter("best", lambda r: first.isNull() | (r["place"] != first))
    return asked.join(best, F.col("class") == F.col("query")) \
        .select("query_id", F.posexplode(F.slice(others, 1, k))) \
        .select("query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", "col.score")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Query vectors, ``CHUNK`` in a row."""
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK):
            part = batch.slice(i, CHUNK)
            yield pa.RecordBatch.from_arrays([
                pa.array([part.column("class").to_pylist()], pa.list_(pa.int64())),
                pa.array([part.column("packed").to_pylist()], pa.list_(pa.binary()))], names=["members", "packed_list"])
