"""Token-id files in a word-aligned Simple-8b coding.

Every 64-bit word holds a 4-bit selector and 60 payload bits: ``count`` ids of
``width`` bits each, lowest bits first. An id of 60 bits or more does not fit;
its word carries the escape selector and the id follows as a raw word.

A file set is a Parquet table of *pages*, so Spark's commit protocol, storage
and recovery apply. A page holds the ids of whole documents:

    shard, page         place of the page
    first_id            ids of the shard before this page
    doc_id, doc_tokens  the page's documents and their id counts, in order
    words               the coded words, little endian
    block_offsets       int32: ids before every 128th word, so that a reader
                        may start at any block and decode all blocks at once

Shards are ranges of ascending ``doc_id``; ``<path>/index`` lists the shards
with their first id, the only global step, so no id passes through one task.

Defined cases: null text is empty and gives the end id alone; null ``doc_id``
sorts first; rows with equal ids are kept, ordered by a hash of their text;
an empty table gives no pages; other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, as_bytes, ready, slices, tidy
from shopstream.llm.words import span_hashes, word_spans

PAGE_IDS = 1 << 16
#: Text encoded at a time in a task.
ENCODE_BYTES = 1 << 20
#: New pieces that are merged at a time, and bytes of other new words in one call of the tokenizer, which
#: keeps some hundred bytes for each id of a call; a longer word is taken whole.
LEARN_WORDS = 1 << 13
LEARN_BYTES = 1 << 14
BLOCK_WORDS = 128
END_ID = 2
TOKENIZER_FILE = "word_bpe_49k.json"

_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
#: Bits of each small number.
_BITS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)

#: Bits for each id, by selector; a word of that selector holds 60 // bits ids.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNTS = 60 // WIDTHS
ESCAPE = 15

PAGE_SCHEMA = ("shard int, page int, first_id long, doc_id array<long>, doc_tokens array<int>, "
               "words binary, block_offsets binary")
DIGEST_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
TOKENS_SCHEMA = "doc_id long, start long, ids array<long>"


# ---------------------------------------------------------------- coding

def encode_ids(ids: np.ndarray) -> np.ndarray:
    """Simple-8b words of non-negative 64-bit ids (greedy: most ids for each word)."""
    n = len(ids)
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    if n == 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([ids, np.zeros(COUNTS[0], np.uint64)])
    if ids.max() < len(_BITS):
        top = _BITS[padded.astype(np.int32)]
    else:
        top = np.searchsorted(_POWERS, padded, side="right").astype(np.uint8)
    selector = np.full(n, ESCAPE, np.int8)
    have = 1
    # Widest ids first: a selector with more ids wins wherever all of them fit.
    for s in range(len(WIDTHS) - 1, -1, -1):
        count = int(COUNTS[s])
        while have < count:  # top[i] = most bits among ids i .. i + have - 1
            step = min(have, count - have)
            top = np.maximum(top[:len(top) - step], top[step:])
            have += step
        fits = top[:n] <= WIDTHS[s]
        if not fits.any():
            break  # nor do more ids of fewer bits
        np.putmask(selector, fits, s)
    starts = _chain(np.append(COUNTS, [0, 1])[selector])
    chosen = selector[starts]
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(chosen == ESCAPE)[:-1]])
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), np.uint64)
    words[place] = chosen.astype(np.uint64)
    for s in np.unique(chosen):
        at = chosen == s
        if s == ESCAPE:
            words[place[at] + 1] = padded[starts[at]]
            continue
        first, word = starts[at], np.full(np.count_nonzero(at), s, np.uint64)
        for k in range(int(COUNTS[s])):
            word |= padded[first + k] << np.uint64(4 + k * int(WIDTHS[s]))
        words[place[at]] = word
    return words


def _chain(step: np.ndarray) -> np.ndarray:
    """Places 0, 0 + step[0], and so on, before the end: every 16th one by one, those between for all at once."""
    n = len(step)
    ahead = np.append(np.minimum(np.arange(n) + step, n), n)
    far = ahead
    for _ in range(4):
        far = far[far]
    marks, i = [], 0
    while i < n:
        marks.append(i)
        i = int(far[i])
    out = np.empty((len(marks), 16), np.int64)
    out[:, 0] = marks
    for k in range(1, 16):
        out[:, k] = ahead[out[:, k - 1]]
    out = out.ravel()
    return out[out < n]


def _layout(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selector of each word and ids before it; a raw word has selector -1 and no ids."""
    selector = (words & np.uint64(15)).astype(np.int8)
    suspect = np.flatnonzero(selector == ESCAPE)
    for i in suspect:  # in order: the word after an escape is raw, whatever its low bits
        if selector[i] == ESCAPE and i + 1 < len(words):
            selector[i + 1] = -1
    count = np.append(COUNTS, [0, 1, 0])[selector]  # selector -1 takes the last entry
    return selector, np.cumsum(count) - count


def block_offsets(words: np.ndarray) -> np.ndarray:
    return _layout(words)[1][::BLOCK_WORDS].astype(np.int32)


def decode_ids(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``encode_ids``, all words of a selector at a time."""
    selector, before = _layout(words)
    out = np.zeros(n + int(COUNTS[0]), np.uint64)
    # The last word may hold padding beyond n; later writes must not undo earlier ones,
    # which holds because words own disjoint id ranges.
    for s in np.unique(selector):
        at = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[before[at]] = words[at + 1]
        elif s >= 0:
            shift = np.uint64(4) + np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s])
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            out[before[at][:, None] + np.arange(COUNTS[s])] = (words[at][:, None] >> shift) & mask
    return out[:n]


# ---------------------------------------------------------------- tokenizing

#: ASCII marks without the apostrophe, which starts contractions, and what could be part of a special token.
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~")] = True
_A_TO_Z = np.zeros(256, bool)
_A_TO_Z[ord("a"):ord("z") + 1] = True
#: After 0xC3, a lower-case Latin letter.
_AFTER_C3 = np.zeros(256, bool)
_AFTER_C3[0xA0:0xC0] = True
_AFTER_C3[0xB7] = False


def _letters_then_marks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word is lower-case Latin letters, then perhaps ASCII marks; if so, where its letters end.

    The words stand in ``data`` one after the other, with nothing between.
    """
    letter, mark = _A_TO_Z[data], _MARK[data]
    two = (data[:-1] == 0xC3) & _AFTER_C3[data[1:]]
    letter[:-1] |= two
    letter[1:] |= two
    wrong = ~(letter | mark)
    wrong[1:] |= letter[1:] & mark[:-1]
    wrong[start] = ~letter[start]
    return ~np.logical_or.reduceat(wrong, start), start + np.add.reduceat(letter, start, dtype=np.int64)


#: A special token of the vocabulary.
_APART = b"<|startoftext|>"


class WordCache:
    """Token ids by white-space separated word, through the ``tokenizers`` library.

    This tokenizer collapses white space and splits at it before its merges, so a
    text's ids are its words' ids in a row (tests compare with whole-text encoding).
    A slice's words are told apart by a 64-bit hash; distinct words are encoded
    once and kept, and so are the letters and the marks of words of both: the cache
    starts anew when it holds ``limit`` words and such pieces, or 8 times as many ids.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.apart = self.tokenizer.token_to_id(_APART.decode())
        # How the tokenizer writes each accented letter before its merges.
        self.spelling = str.maketrans({
            c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xE0, 0x100)) if c != "\xf7"})
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known = word_spans(_END)[3]  # hashes in order
        self.rank = np.zeros(1, np.int32)  # entry of each
        self.first, self.length, self.flat = _Growing(np.int32), _Growing(np.int32), _Growing(np.int32)
        self._append(np.zeros(1, np.int32), np.ones(1, np.int64))

    def _append(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        begin, entry = self.flat.size, self.first.size
        self.first.extend(begin + np.cumsum(length) - length)
        self.length.extend(length)
        self.flat.extend(ids)
        return np.arange(entry, entry + len(length))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, length = self.first.data[at].astype(np.int64), self.length.data[at].astype(np.int64)
        ends = np.cumsum(length)
        where = np.repeat(first - ends + length, length)
        where += np.arange(len(where))
        return self.flat.data[where], length

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash; -1: not known."""
        order = np.argsort(h)  # a search in order is the faster one
        at = np.empty(len(h), np.int64)
        at[order] = np.minimum(np.searchsorted(self.known, h[order]), len(self.known) - 1)
        return np.where(self.known[at] == h, self.rank[at], -1)

    def _add(self, h: np.ndarray, entry: np.ndarray) -> None:
        order = np.argsort(h)
        to = np.searchsorted(self.known, h[order])
        self.known = np.insert(self.known, to, h[order])
        self.rank = np.insert(self.rank, to, entry[order])

    def _merge_pieces(self, data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Runs of Latin letters or of marks are single pieces: only the merges are left to do."""
        tokenize, flat, length = self.tokenizer.model.tokenize, [], []
        for i in range(0, len(start), LEARN_WORDS):
            to = slice(i, i + LEARN_WORDS)
            part = b" ".join([data[a:b] for a, b in zip(start[to].tolist(), end[to].tolist())])
            ids = [[t.id for t in tokenize(p)] for p in part.decode().translate(self.spelling).split(" ")]
            flat.append(np.array(list(chain.from_iterable(ids)), np.int32))
            length.append(np.array(list(map(len, ids)), np.int64))
        return self._append(np.concatenate(flat), np.concatenate(length))

    def _encode_words(self, words: list[bytes]) -> np.ndarray:
        """Any words, whole, many in a call: a special token ends the text before it."""
        flat, length = [], []
        ends, i = np.cumsum([len(w) for w in words]), 0
        while i < len(words):
            to = max(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + LEARN_BYTES, side="right")), i + 1)
            part = words[i:to]
            i = to
            if any(b"<|" in w for w in part):
                for w in part:
                    flat.append(np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.int32))
                    length.append([len(flat[-1])])
                continue
            ids = self.tokenizer.encode(_APART.join(part).decode(), add_special_tokens=False).ids
            ids = np.array(ids + [self.apart], np.int32)
            flat.append(ids[ids != self.apart])
            length.append(np.diff(np.flatnonzero(ids == self.apart), prepend=-1) - 1)
        return self._append(np.concatenate(flat), np.concatenate(length).astype(np.int64))

    def _learn(self, data: np.ndarray, length: np.ndarray, h: np.ndarray) -> None:
        """Take in new words, which stand in ``data`` one after the other."""
        end = np.cumsum(length)
        start = end - length
        plain, mid = _letters_then_marks(data, start, end)
        both, raw = plain & (mid < end), data.tobytes()
        if not plain.all():
            words = [raw[a:b] for a, b in zip(start[~plain].tolist(), end[~plain].tolist())]
            self._add(h[~plain], self._encode_words(words))
        # Letters, marks, letters, marks ...
        first, last = (np.column_stack(x).ravel() for x in ((start[both], mid[both]), (mid[both], end[both])))
        halves, alone = span_hashes(data, first, last), plain & (mid == end)
        new, at = np.unique(np.concatenate([h[alone], halves]), return_index=True)
        lack = self._find(new) < 0
        if lack.any():
            new, at = new[lack], at[lack]
            first, last = np.concatenate([start[alone], first])[at], np.concatenate([end[alone], last])[at]
            self._add(new, self._merge_pieces(raw, first, last))
        if both.any():
            ids, length = self._gather(self._find(halves))
            self._add(h[both], self._append(ids, length.reshape(-1, 2).sum(axis=1)))

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, each text followed by ``end_id``, and the number of ids of each."""
        # The tokenizer lower-cases, but not its special tokens.
        data = np.frombuffer(bytearray().join(t + _END for t in (t if b"<|" in t else t.lower() for t in texts)), np.uint8)
        second = data[1:]
        second[(data[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)] += 0x20  # A-grave to Thorn
        _, start, end, h = word_spans(data)
        which, distinct = pd.factorize(h)
        if len(self.known) + len(distinct) > self.limit or self.flat.size > 8 * self.limit:
            self.clear()
        entry = self._find(distinct)
        lack = np.flatnonzero(entry < 0)
        if len(lack):
            some = np.zeros(len(distinct), np.int64)
            some[which] = np.arange(len(which))  # a place of each word
            at = some[lack]
            length = end[at] - start[at]
            where = np.repeat(end[at] - np.cumsum(length), length)
            where += np.arange(len(where))
            self._learn(data[where], length, distinct[lack])
            entry[lack] = self._find(distinct[lack])
        ids, length = self._gather(entry[which])
        stops = np.cumsum(length)[data[start] == 0xFF]
        ids[stops - 1] = end_id
        return ids, np.diff(stops, prepend=0)


class _Growing:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            more = np.empty(len(self.data) + need, self.data.dtype)  # memory that is not written is not taken
            more[:self.size] = self.data[:self.size]
            self.data = more
        self.data[self.size:need] = values
        self.size = need


#: Stands between texts and has one id; the byte is in no UTF-8 text.
_END = b" \xff "

@functools.lru_cache(maxsize=1)
def word_cache(path: str) -> WordCache:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return WordCache(path)


# ---------------------------------------------------------------- files

def _pages(path: str, end_id: int, page_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard = word_cache(path), TaskContext.get().partitionId()
        state = {"page": 0, "first": 0}

        def page(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> dict:
            words = encode_ids(ids)
            out = {"shard": shard, "page": state["page"], "first_id": state["first"], "doc_id": doc_ids,
                   "doc_tokens": counts.tolist(), "words": words.astype("<u8").tobytes(),
                   "block_offsets": block_offsets(words).astype("<i4").tobytes()}
            state["page"] += 1
            state["first"] += len(ids)
            return out

        for batch in batches:
            for part in slices(batch, "text", ENCODE_BYTES):
                ids, counts = cache.encode(as_bytes(part.column("text")), end_id)
                doc_ids = part.column("doc_id").to_pylist()
                ends = np.cumsum(counts)
                begin, rows = 0, []
                while begin < len(counts):
                    base = ends[begin] - counts[begin]
                    end = max(int(np.searchsorted(ends, base + page_ids, side="right")), begin + 1)
                    rows.append(page(doc_ids[begin:end], counts[begin:end], ids[base:ends[end - 1]]))
                    begin = end
                yield pa.RecordBatch.from_pylist(rows, schema=_PAGE_ARROW)
    return run


_PAGE_ARROW = pa.schema([
    ("shard", pa.int32()), ("page", pa.int32()), ("first_id", pa.int64()), ("doc_id", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int32())), ("words", pa.binary()), ("block_offsets", pa.binary())])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                      page_ids: int = PAGE_IDS) -> None:
    """Tokenize ``docs`` (doc_id, text) and write pages and index below ``path``.

    One range shuffle puts the texts in ascending order; encoding and writing
    happen in its tasks.
    """
    spark = ready(docs.sparkSession)
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.coalesce(F.col("text"), F.lit("")).alias("text"))
               .repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie))
    ordered.mapInArrow(tidy(_pages(tokenizer_path, end_id, page_ids)), PAGE_SCHEMA).write.parquet(f"{path}/pages")
    pages = spark.read.schema(PAGE_SCHEMA).parquet(f"{path}/pages")
    shards = (pages.groupBy("shard").agg(
        F.sum(F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_ids"),
        F.sum(F.size("doc_id").cast("long")).alias("n_docs")).orderBy("shard").collect())  # a row for each task
    total, index = 0, []
    for r in shards:
        index.append((r.shard, total, r.n_ids, r.n_docs))
        total += r.n_ids
    spark.createDataFrame(index, "shard int, first_id long, n_ids long, n_docs long").coalesce(1) \
        .write.parquet(f"{path}/index")


def _read_pages(spark: SparkSession, path: str, per_page, schema: str) -> DataFrame:
    """Decode every page; ``per_page(doc_ids, starts, counts, ids)`` gives the columns."""
    index = ready(spark).read.parquet(f"{path}/index").select("shard", "first_id").collect()
    base = {r.shard: r.first_id for r in index}  # a number for each shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {k: batch.column(k)[i] for k in ("shard", "first_id", "doc_id", "doc_tokens", "words")}
                counts = np.array(r["doc_tokens"].as_py(), np.int64)
                ends = np.cumsum(counts)
                words = np.frombuffer(r["words"].as_buffer(), "<u8")
                ids = decode_ids(words, int(ends[-1]))
                start = base[r["shard"].as_py()] + r["first_id"].as_py() + ends - counts
                yield per_page(r["doc_id"].as_py(), start, ends - counts, ends, ids)

    pages = spark.read.schema(PAGE_SCHEMA).parquet(f"{path}/pages")
    return pages.drop("page", "block_offsets").mapInArrow(tidy(run), schema)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): the decoded ids of each document."""
    def rows(doc_ids, start, first, ends, ids):
        values = pa.array(ids.astype(np.int64))
        return pa.RecordBatch.from_arrays([
            pa.array(doc_ids, pa.int64()), pa.array(start),
            pa.ListArray.from_arrays(pa.array(np.append(first, ends[-1]).astype(np.int32)), values)],
            names=["doc_id", "start", "ids"])
    return _read_pages(spark, path, rows, TOKENS_SCHEMA)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the decoded ids."""
    def rows(doc_ids, start, first, ends, ids):
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(first, ends)]
        return pa.RecordBatch.from_arrays([
            pa.array(doc_ids, pa.int64()), pa.array(start), pa.array(ends - first), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return _read_pages(spark, path, rows, DIGEST_SCHEMA)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def token_file_digests(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None) -> DataFrame:
    """Write ``docs`` as token files (to scratch space unless ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = path or Scratch(spark, "token-files").path("set")
    write_token_files(docs, path, tokenizer_path or default_tokenizer())
    return read_token_digests(spark, path)
