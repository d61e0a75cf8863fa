"""Benchmark decontamination with suffix arrays over the training documents.

A shard is a run of documents inside one task. Its words become numbers of the
benchmark's vocabulary; a run of known words shorter than the shortest window
can't match and is left out, the rest is sorted into a suffix array by prefix
doubling. All benchmark suffixes are binary-searched in it at once, which gives
each one's longest verbatim match; the ones that cover a window give the
interval of the array with every place where that window occurs.

Documents never leave their task, so nothing is shuffled. The benchmark is
broadcast in blocks of at most ``block_bytes`` of text; with more than one
block the documents pass once for each, written to scratch in between, so
one block is in memory at a time whatever the benchmark's size.

Words: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. A
window is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window.

Defined cases: null or empty text has no words and no match; an item without
words matches nothing; an item without id marks words but is not listed; equal
items and equal documents are treated each for itself; empty tables give an
empty result or one without matches; other columns are ignored
(``remove_contaminated`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, as_bytes, ready, slices, tidy

WINDOW = 10
#: Benchmark text in one broadcast.
BLOCK_BYTES = 8 << 20

_TABLE = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A
               or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20 for c in range(256))
#: Stands between documents; the byte is in no UTF-8 text.
_EDGE = b" \xff "

MATCH_SCHEMA = ("doc_id long, n_words long, spans array<struct<begin:int,end:int>>, items array<string>, "
                "longest struct<item_id:string,item_word:int,doc_word:int,n_words:int>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string())),
    ("longest", pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()),
                           ("n_words", pa.int32())]))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class BenchmarkBlock:
    """One block of benchmark items: vocabulary, concatenated words and distinct windows."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        numbers, self.items, item_of, place = [], [], [], []
        for item_id, text in items:
            words = words_of(text or b"")
            if not words:
                continue
            numbers += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] + [0]
            item_of += [len(self.items)] * (len(words) + 1)
            place += range(len(words) + 1)
            self.items.append(item_id)
        self.words = np.array(numbers, np.int32)  # 0 ends an item
        self.item_of, self.place = np.array(item_of, np.int32), np.array(place, np.int32)
        n = len(self.words)
        ends = np.flatnonzero(self.words == 0)
        self.rest = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) if n else np.zeros(0, np.int64)
        self.longest_item = int(self.rest.max(initial=0))
        # Windows start where at least ``window`` words remain, or at the start of a shorter item.
        starts = np.flatnonzero((self.rest >= window) | ((self.place == 0) & (self.rest > 0)))
        length = np.minimum(self.rest[starts], window)
        self.shortest = int(length.min(initial=window))
        padded = np.concatenate([self.words, np.zeros(window, np.int32)])
        grid = padded[starts[:, None] + np.arange(window)] * (np.arange(window) < length[:, None])
        _, first, which = np.unique(grid, axis=0, return_index=True, return_inverse=True)
        which = which.ravel()
        self.window_at, self.window_len = starts[first], length[first]
        owners = np.unique(np.stack([which, self.item_of[starts]], axis=1), axis=0) if len(starts) \
            else np.zeros((0, 2), np.int64)
        self.owner_item = owners[:, 1]
        self.owner_from = np.searchsorted(owners[:, 0], np.arange(len(first) + 1))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in order of at least their first ``depth`` words (prefix doubling)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < depth:
        ahead = np.zeros(n, np.int64)
        ahead[:n - have] = rank[have:] + 1
        distinct, rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)
        have *= 2
        if len(distinct) == n:
            break
    return np.argsort(rank, kind="stable")


def common_prefix(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words of a[at:] and b[bt:], at most ``most`` each; 0 equals nothing."""
    out = np.zeros(len(at), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        x, y = at[live] + out[live], bt[live] + out[live]
        inside = x < len(a)
        same = np.zeros(len(live), bool)
        same[inside] = (a[x[inside]] == b[y[inside]]) & (a[x[inside]] != 0)
        live = live[same]
        out[live] += 1
        live = live[out[live] < most[live]]
    return out


def _search(text, order, block, at, most, after: bool) -> np.ndarray:
    """For each benchmark suffix, cut to ``most`` words: suffixes of the array before it
    (``after``: or beginning with it)."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        mid = (low[live] + high[live]) // 2
        place = order[mid]
        same = common_prefix(text, place, block.words, at[live], most[live])
        whole = same == most[live]
        x = np.minimum(place + same, len(text) - 1)
        y = np.minimum(at[live] + same, len(block.words) - 1)
        left = np.where(place + same < len(text), text[x], 0)
        smaller = np.where(whole, after, left < block.words[y])
        low[live] = np.where(smaller, mid + 1, low[live])
        high[live] = np.where(smaller, high[live], mid)


def match_shard(texts: list[bytes | None], block: BenchmarkBlock) -> list[tuple[int, list, list, tuple | None]]:
    """(n_words, spans, item numbers, longest match) of each document of a shard."""
    words = (_EDGE + _EDGE.join(t or b"" for t in texts) + _EDGE).translate(_TABLE).split()
    vocabulary = block.vocabulary
    vocabulary[b"\xff"] = -1
    numbers = np.fromiter(map(vocabulary.get, words, repeat(0)), np.int32, len(words))
    del words
    edges = np.flatnonzero(numbers == -1)
    n_words = np.diff(edges) - 1
    out: list = [[int(n), [], [], None] for n in n_words]
    numbers[edges] = 0
    if not len(block.window_at) or not numbers.any():
        return [tuple(x) for x in out]

    # Known words in runs that can hold a window, each closed by a 0.
    stops = np.flatnonzero(numbers == 0)
    place = np.arange(len(numbers))
    run_end = np.append(stops, len(numbers))[np.searchsorted(stops, place)]
    run_start = np.append(-1, stops)[np.searchsorted(stops, place)] + 1
    used = (numbers != 0) & (run_end - run_start >= block.shortest)
    closing = np.zeros(len(numbers), bool)
    closing[1:] = used[:-1] & (numbers[1:] == 0)
    origin = np.flatnonzero(used | closing)
    text = numbers[origin]
    if not used.any():
        return [tuple(x) for x in out]
    order = suffix_array(text, max(block.longest_item, 1))
    order = order[text[order] != 0]

    # Longest match of each benchmark suffix: at its neighbours in the array.
    at = np.flatnonzero(block.words != 0)
    rest = block.rest[at]
    spot = _search(text, order, block, at, rest, False)
    longest = np.zeros(len(block.words), np.int64)
    for neighbour in (spot - 1, spot):
        ok = np.flatnonzero((neighbour >= 0) & (neighbour < len(order)))
        got = common_prefix(text, order[neighbour[ok]], block.words, at[ok], rest[ok])
        longest[at[ok]] = np.maximum(longest[at[ok]], got)

    # Every place of every window that occurs.
    w = np.flatnonzero(longest[block.window_at] >= block.window_len)
    if not len(w):
        return [tuple(x) for x in out]
    start, length = block.window_at[w], block.window_len[w]
    low, high = _search(text, order, block, start, length, False), _search(text, order, block, start, length, True)
    count = high - low
    which = np.repeat(np.arange(len(w)), count)
    place = order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]

    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + length[which], -1)
    hit = np.zeros(len(numbers) + 1, np.int8)
    hit[origin[np.cumsum(change)[:-1] > 0]] = 1
    flips = np.diff(hit, prepend=0)
    begins, ends = np.flatnonzero(flips == 1), np.flatnonzero(flips == -1)
    doc = np.searchsorted(edges, begins) - 1  # a run never crosses an edge, its word is 0
    for d, b, e in zip(doc.tolist(), (begins - edges[doc] - 1).tolist(), (ends - edges[doc] - 1).tolist()):
        out[d][1].append((b, e))

    doc = np.searchsorted(edges, origin[place]) - 1
    pairs = np.unique(doc * len(w) + which)
    d, k = pairs // len(w), w[pairs % len(w)]
    owners = block.owner_from[k + 1] - block.owner_from[k]
    own = block.owner_item[np.repeat(block.owner_from[k] - np.cumsum(owners) + owners, owners)
                           + np.arange(owners.sum())]
    listed = np.unique(np.repeat(d, owners).astype(np.int64) * len(block.items) + own)
    for i, item in zip((listed // len(block.items)).tolist(), (listed % len(block.items)).tolist()):
        out[i][2].append(item)

    full = common_prefix(text, place, block.words, start[which], block.rest[start[which]])
    best = np.lexsort((place, -full, doc))
    best = best[np.unique(doc[best], return_index=True)[1]]
    for i in best:
        s = start[which[i]]
        out[doc[i]][3] = (int(block.item_of[s]), int(block.place[s]),
                          int(origin[place[i]] - edges[doc[i]] - 1), int(full[i]))
    return [tuple(x) for x in out]


def _merge_spans(a: list, b: list) -> list:
    out: list = []
    for begin, end in sorted(a + b):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator:
    """Broadcasts of the benchmark, block by block; an empty benchmark is one empty block."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    n = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        part = rows.where(block == i) if n > 1 else rows
        items = sorted(((r.item_id, (r.text or "").encode()) for r in part.collect()),
                       key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        yield i == n - 1, spark.sparkContext.broadcast(BenchmarkBlock(items, window))


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items, longest) of each document.

    ``spans`` are the hit words as ranges [begin, end) of word numbers, ``items``
    the ids with an occurring window, ``longest`` the longest verbatim match
    found from a window, with its place in the item and in the document.
    """
    spark = ready(docs.sparkSession)
    scratch = Scratch(spark, "decontamination")
    at = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    carried = False
    for last, block in _blocks(benchmark, window, block_bytes):
        at = at.mapInArrow(tidy(_matcher(block, carried, last)), MATCH_SCHEMA + ("" if last else ", text string"))
        if not last:
            at, carried = scratch.table(at, "block"), True
    return at


def _matcher(shared, carried: bool, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                rows = []
                for i, (n, spans, items, best) in enumerate(match_shard(as_bytes(part.column("text")), block)):
                    items = sorted({block.items[k] for k in items} - {None})
                    longest = best and {"item_id": block.items[best[0]], "item_word": best[1],
                                        "doc_word": best[2], "n_words": best[3]}
                    if carried:
                        old = {k: part.column(k)[i].as_py() for k in ("spans", "items", "longest")}
                        spans = _merge_spans(spans, [(s["begin"], s["end"]) for s in old["spans"]])
                        items = sorted({*items, *old["items"]})
                        if old["longest"] and (not longest or old["longest"]["n_words"] >= longest["n_words"]):
                            longest = old["longest"]
                    rows.append({"doc_id": ids[i], "n_words": n, "items": items, "longest": longest,
                                 "spans": [{"begin": b, "end": e} for b, e in spans]})
                found = pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                yield found if last else pa.RecordBatch.from_arrays(
                    [*found.columns, part.column("text")], names=[*_ARROW.names, "text"])
    return run


def contamination_digest(matches: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) from the matches."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return matches.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents in which a window occurs."""
    ready(docs.sparkSession)

    def keep(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    clean = [not spans for _, spans, _, _ in match_shard(as_bytes(part.column("text")), shared.value)]
                    yield part.filter(pa.array(clean))
        return run

    scratch = Scratch(docs.sparkSession, "decontamination")
    for last, block in _blocks(benchmark, window, block_bytes):
        docs = docs.mapInArrow(tidy(keep(block)), docs.schema)
        if not last:
            docs = scratch.table(docs, "block")
    return docs
