"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both tokenizers cut the same bytes; where a token of each ends at the same byte, a group
of tokens ends. Tokens of A and B whose bytes overlap are linked.

1. *Tokens.* Texts are cut before spaces at which neither tokenizer merges across; a unit
   is encoded and aligned once in a task and looked up afterwards (equal to encoding the whole
   text, tested; both tokenizers end a token, so a group, at the end of a unit). The byte ends
   of tokens are the running sums of their lengths. A full cache keeps the units used most.
2. *Alignment* (``align``) walks two arrays of ends, those of all new units in a row. While
   the ends at the current index shift agree, a run of one-to-one groups is jumped by
   exponential probing: twice as many ends are compared at each step, then half as many. Where
   they disagree, the group is resolved locally by moving whichever token ends first, and the
   shift changes.
3. *Counts.* A block (a few MB of text) is one row: its documents, its distinct
   linked id pairs, and its links as numbers of these pairs, packed. Only the distinct
   pairs of blocks are shuffled to be counted over the corpus, and come back to their
   blocks with the count; links themselves move once.

Defined cases: null and empty texts, and texts whose tokens' bytes are not the text (for
instance those with U+2581), have no tokens: zeros and an empty string; a null or repeated
``doc_id`` keeps its rows; a document of any length is in one block; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, ready, slices, tidy

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
#: Text aligned at a time, a block.
BLOCK_BYTES = 1 << 20
#: Ids fit 16 bits; a pair is the id of A times this plus the id of B.
_SIDE = 1 << 16
#: Units kept by a task's cache, their characters, units encoded in a row, and rows encoded at a time.
UNITS = 250_000
UNIT_CHARS = 8 << 20
_LEARN = 256
_ROWS = 64

BLOCK_SCHEMA = "docs binary, pairs binary, pair_links binary, links binary, link_bytes int"
DIGEST_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                 "groups_sha256 string")
GROUP_SCHEMA = ("doc_id long, a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>, "
                "link_a array<int>, link_b array<int>")


# ---------------------------------------------------------------- alignment

@dataclass
class Alignment:
    """Tokens before the end of each group, and linked pairs of token places, both ascending."""
    a_stops: np.ndarray
    b_stops: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(a: list[int], b: list[int]) -> Alignment:
    """Groups and links of two ascending lists of ends with the same last end."""
    i, j, n = 0, 0, len(a)
    starts, sizes = [], []  # one-to-one runs: first places and length
    stop_a, stop_b, linked_a = [], [], []  # irregular groups, and the tokens of A of their links
    while i < n:
        p, q = a[i], b[j]
        if p == q:
            step = run = 1
            while a[i + run:i + run + step] == b[j + run:j + run + step] and i + run < n:
                run += step
                step *= 2
            run = min(run, n - i)
            while step > 1:
                step //= 2
                if i + run + step <= n and a[i + run:i + run + step] == b[j + run:j + run + step]:
                    run += step
            starts.append((i, j))
            sizes.append(run)
            i += run
            j += run
            continue
        while p != q:
            linked_a.append(i)
            if p < q:
                i += 1
                p = a[i]
            else:
                j += 1
                q = b[j]
        linked_a.append(i)
        i += 1
        j += 1
        stop_a.append(i)
        stop_b.append(j)
    size = np.array(sizes, np.int64)
    first = np.array(starts, np.int64).reshape(-1, 2)
    ahead = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    one_a, one_b = np.repeat(first[:, 0], size) + ahead, np.repeat(first[:, 1], size) + ahead

    x, y = np.concatenate([np.array(stop_a, np.int64), one_a + 1]), np.concatenate([np.array(stop_b, np.int64), one_b + 1])
    order = np.argsort(x + y, kind="stable")  # the sum of places ascends along groups
    x, y = x[order], y[order]
    # Each link of a group moves one side on: the sum of its places is one more than that of the link before.
    begin_a, begin_b = np.append(0, x[:-1]), np.append(0, y[:-1])
    begin = (begin_a + begin_b)[:len(x)]
    n_links = x + y - begin - 1
    ends = np.cumsum(n_links)
    link_a = np.repeat(begin_a[:len(x)], n_links)
    link_a[np.repeat(n_links > 1, n_links)] = linked_a
    total = np.arange(len(link_a)) + np.repeat(begin - ends + n_links, n_links)
    return Alignment(x, y, link_a, total - link_a)


def group_text(a_ids: np.ndarray, b_ids: np.ndarray, al: Alignment) -> tuple[np.ndarray, np.ndarray]:
    """Bytes ``a1,a2|b1;a3|b2,b3;`` of all groups, and the end of each group in them."""
    n_a, n_b = len(a_ids), len(b_ids)
    a_size, b_size = np.diff(al.a_stops, prepend=0), np.diff(al.b_stops, prepend=0)
    group_a, group_b = np.repeat(np.arange(len(a_size)), a_size), np.repeat(np.arange(len(b_size)), b_size)
    place_a = np.arange(n_a) + (al.b_stops - b_size)[group_a]
    place_b = np.arange(n_b) + al.a_stops[group_b]
    ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a_ids, b_ids
    ends = al.a_stops + al.b_stops
    mark[ends - 1 - b_size] = ord("|")
    mark[ends - 1] = ord(";")
    digits, length = _digits()
    wide = digits[ids]  # a copy
    wide[np.arange(len(ids)), length[ids]] = mark
    keep = np.arange(wide.shape[1]) <= length[ids][:, None]
    return wide[keep], np.cumsum(length[ids] + 1)[ends - 1]


@functools.lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all 16-bit numbers with room for a mark, and how many they are."""
    numbers = [b"%d" % i for i in range(_SIDE)]
    wide = np.frombuffer(b"".join(x.ljust(6) for x in numbers), np.uint8).reshape(_SIDE, 6)
    return wide, np.array([len(x) for x in numbers])


# ---------------------------------------------------------------- tokens

#: White space and a space: where a cut needs a closer look, as at two spaces and at an end.
_CLOSER = [chr(i) + " " for i in range(0x3001) if chr(i).isspace() and i != 0x20]


def units_of(text: str) -> list[str]:
    """The text in units, each without the space before it; no token of either tokenizer spans two.

    Both tokenizers begin a new token at a space that follows something else than white
    space. The cut is made if something else than a space follows.
    """
    parts = text.split(" ")
    if "" not in parts and not any(c in text for c in _CLOSER):
        return parts
    out = [parts[0]]
    open_ = not parts[0] or parts[0][-1].isspace()
    for p in parts[1:]:
        if open_ or not p:
            out[-1] += " " + p
        else:
            out.append(p)
        open_ = not p or p[-1].isspace()
    while len(out) > 1 and not out[-1].strip(" "):  # white space at the end belongs to the unit before
        last = out.pop()
        out[-1] += " " + last
    return out


class _Numbered(dict):
    """Numbers of units from 0 in the order in which they were asked for; ``new`` are those asked for first since it was emptied."""

    def __init__(self, units: Iterable[str] = ()):
        super().__init__(zip(units, itertools.count()))
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


class Tokens:
    """Token ids of texts by both tokenizers, their lengths in bytes, and their links; units are encoded and aligned once."""

    def __init__(self, a_path: str, b_path: str, limit: int = UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > _SIDE:
            raise ValueError("a vocabulary has more than 65,536 ids")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known = _Numbered()
        self.sides = _Ragged(np.uint16), _Ragged(np.uint16)
        self.links = _Ragged(np.uint32)  # pairs of the links
        self.text: list[bytes] = []  # of the groups
        # Of each unit: its groups, whether its bytes are not the text's, and how often it was used of late.
        self.n_groups, self.odd, self.uses = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        self.chars = 0

    def _forget(self) -> None:
        """Keep the units used most and at least twice, half of the limit at most; older uses count less at the next time."""
        often = np.flatnonzero(self.uses >= 2)
        keep = np.sort(often[np.argsort(-self.uses[often], kind="stable")[:self.limit // 2]])
        units, text = list(self.known), self.text
        units = [units[i] for i in keep]
        chars = sum(map(len, units))
        if chars > UNIT_CHARS // 2:
            self.clear()
            return
        self.known, self.chars, self.text = _Numbered(units), chars, [text[i] for i in keep]
        for of in (*self.sides, self.links):
            of.keep(keep)
        self.n_groups, self.odd, self.uses = self.n_groups[keep], self.odd[keep], self.uses[keep] // 2

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def whole(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of whole texts by A (with a space before) and B; None if their bytes are not the text's."""
        out = []
        for text, x, y in zip(texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False),
                              self.b.encode(texts, num_threads=1)):
            want, x = (" " + text).encode(), x.ids
            same = (b"".join(map(self.a_bytes.__getitem__, x)) == want
                    and b"".join(map(self.b_bytes.__getitem__, y)) == want)
            out.append((np.array(x, np.uint16), np.array(y, np.uint16)) if same else None)
        return out

    def _encoded(self, parts: list[list[str]]) -> Iterator[tuple[list[str], tuple[np.ndarray, np.ndarray] | None]]:
        """Many units in a row are one text; one with other bytes is halved until the units with other bytes are alone."""
        for i in range(0, len(parts), _ROWS):
            for units, pair in zip(parts[i:i + _ROWS], self.whole([" ".join(units) for units in parts[i:i + _ROWS]])):
                if pair is None and len(units) > 1:
                    yield from self._encoded([units[:len(units) // 2], units[len(units) // 2:]])
                else:
                    yield units, pair

    def _learn(self, new: list[str], most: int) -> None:
        """Encode and align units, ``most`` at most in a row; each is cut again where its bytes end."""
        parts, open_ = [], False
        for u in new:
            plain = bool(u) and u[0] != " " and not u[-1].isspace()
            if open_ and plain and len(parts[-1]) < most:
                parts[-1].append(u)
            else:
                parts.append([u])
            open_ = plain
        size, odd, rows = [], [], []
        for units, pair in self._encoded(parts):
            size += [len(u.encode()) + 1 for u in units] if pair else [0]
            odd += [pair is None] * len(units)
            rows.append(pair or (_NO_IDS, _NO_IDS))
        ends = np.cumsum(size)
        a_ids, b_ids = (np.concatenate(ids) for ids in zip(*rows))
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        stops = [np.searchsorted(e, ends, side="right") for e in (a_ends, b_ends)]
        al = align(a_ends.tolist(), b_ends.tolist())
        groups = np.searchsorted(al.a_stops, stops[0], side="right")
        links = np.searchsorted(al.link_a, stops[0], side="left")
        for of, values, stop in zip((*self.sides, self.links), (a_ids, b_ids, _codes(a_ids, b_ids, al)), (*stops, links)):
            of.add(values, np.diff(stop, prepend=0))
        raw, stop = group_text(a_ids, b_ids, al)
        raw, stop = raw.tobytes(), np.append(0, stop)[groups].tolist()
        self.text += [raw[p:q] for p, q in zip([0, *stop], stop)]
        self.n_groups = np.append(self.n_groups, np.diff(groups, prepend=0))
        self.odd, self.uses = np.append(self.odd, odd), np.append(self.uses, np.zeros(len(new), np.int64))
        self.chars += sum(map(len, new))

    def _numbers(self, units: list[str], most: int = _LEARN) -> np.ndarray:
        numbers = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        if self.known.new:
            self._learn(self.known.new, most)
            self.known.new = []
        return numbers

    def _units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts' units in a row, and the units before the end of each text.

        A text that has a unit with other bytes is a unit as a whole, and has no tokens if its own bytes are other ones.
        """
        if len(self.known) > self.limit or self.chars > UNIT_CHARS:
            self._forget()
        units = [units_of(t) for t in texts]
        numbers = self._numbers(list(itertools.chain.from_iterable(units)))
        stops = np.cumsum([len(u) for u in units], dtype=np.int64)
        if self.odd[numbers].any():
            rows = np.split(numbers, stops[:-1])
            odd = [i for i, r in enumerate(rows) if self.odd[r].any()]
            for i, n in zip(odd, self._numbers([texts[i] for i in odd], most=1).tolist()):
                rows[i] = np.array([n])
            numbers, stops = np.concatenate(rows), np.cumsum([len(r) for r in rows])
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        return numbers, stops

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For A and B: the ids of all texts in a row and how many each text has; as ``whole``, from units."""
        numbers, stops = self._units(texts)
        return [side.get(numbers) for side in self.sides], [_sums(side.size[numbers], stops) for side in self.sides]

    def linked(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, list[str]]:
        """Tokens of A, tokens of B, groups and links of each text; pairs of all links in a row; hashes of the groups."""
        numbers, stops = self._units(texts)
        counts = [_sums(x[numbers], stops) for x in (*(side.size for side in self.sides), self.n_groups, self.links.size)]
        each, stop = [self.text[i] for i in numbers.tolist()], stops.tolist()
        raw = [b"".join(each[p:q]) for p, q in zip([0, *stop], stop)]
        return counts, self.links.get(numbers), [hashlib.sha256(memoryview(r)[:-1]).hexdigest() if r else "" for r in raw]


def _codes(a_ids: np.ndarray, b_ids: np.ndarray, al: Alignment) -> np.ndarray:
    """Pairs of all links as numbers."""
    return a_ids[al.link_a].astype(np.uint32) * np.uint32(_SIDE) + b_ids[al.link_b]


def _sums(values: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(values))[stops], prepend=0)


_NO_IDS = np.zeros(0, np.uint16)


class _Ragged:
    """Values of all units in a row, with the number of each unit's."""

    def __init__(self, kind: type):
        self.parts, self.size, self.first = [np.zeros(0, kind)], np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, size: np.ndarray) -> None:
        self.parts.append(values)
        self.size = np.append(self.size, size)
        self.first = np.cumsum(self.size) - self.size

    def get(self, numbers: np.ndarray) -> np.ndarray:
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        size = self.size[numbers]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.parts[0][np.arange(total) + np.repeat(self.first[numbers] - ends + size, size)]

    def keep(self, numbers: np.ndarray) -> None:
        values, size = self.get(numbers), self.size[numbers]
        self.parts, self.size, self.first = [values], size, np.cumsum(size) - size


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@functools.lru_cache(maxsize=1)
def _tokens(a_path: str, b_path: str) -> Tokens:
    return Tokens(a_path, b_path)


# ---------------------------------------------------------------- Spark steps

def _aligned(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]):
    """For each block: ids, token counts a document, ids of all tokens in a row, alignment, tokens."""
    tokens = _tokens(*paths)
    for batch in batches:
        for part in slices(batch, "text", BLOCK_BYTES):
            texts = part.column("text").to_pylist()
            full = [i for i, t in enumerate(texts) if t]
            n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            (a_ids, b_ids), (n_a[full], n_b[full]) = tokens.encode([texts[i] for i in full]) if full else _NO_TEXT
            al = align(np.cumsum(tokens.a_size[a_ids]).tolist(), np.cumsum(tokens.b_size[b_ids]).tolist())
            yield part.column("doc_id").to_pylist(), n_a, n_b, a_ids, b_ids, al


_NO_TEXT = (_NO_IDS,) * 2, (0, 0)


def _blocks(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, tokens = pa.Codec("zstd", 1), _tokens(*paths)
        for part in (p for batch in batches for p in slices(batch, "text", BLOCK_BYTES)):
            texts = part.column("text").to_pylist()
            full = [i for i, t in enumerate(texts) if t]
            counts, digest = np.zeros((4, len(texts)), np.int64), [""] * len(texts)
            pairs = np.zeros(0, np.uint32)
            if full:
                counts[:, full], pairs, hashes = tokens.linked([texts[i] for i in full])
                for i, h in zip(full, hashes):
                    digest[i] = h
            code, distinct = pd.factorize(pairs)
            order = np.argsort(distinct)
            place = np.empty(len(order), np.uint16 if len(order) <= _SIDE else np.uint32)
            place[order] = np.arange(len(order))
            packed = place[code].tobytes()
            docs = pa.RecordBatch.from_arrays([
                part.column("doc_id"), *map(pa.array, counts), pa.array(digest, pa.string())], names=list(_DOC_COLUMNS))
            row = [docs.serialize().to_pybytes(), distinct[order].astype("<u4").tobytes(),
                   np.bincount(code, minlength=len(order))[order].astype("<u4").tobytes(),
                   codec.compress(packed, asbytes=True) if packed else b"", len(packed)]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BLOCK_ARROW.types)],
                                             schema=_BLOCK_ARROW)
    return run


#: What a block knows of its documents, before the counts come back.
_DOC_COLUMNS = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
                "groups_sha256": pa.string()}
_BLOCK_ARROW = pa.schema([("docs", pa.binary()), ("pairs", pa.binary()), ("pair_links", pa.binary()),
                          ("links", pa.binary()), ("link_bytes", pa.int32())])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, n in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "pair_links"))):
            pairs = np.frombuffer(pairs, "<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array(pairs),
                                              pa.array(np.frombuffer(n, "<u4").astype(np.int64))], names=["block", "pair", "n"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and pair: a block's own row (pair -1), then the counts of its pairs."""
    head, counts, best = None, [], []
    for batch in batches:
        pair = batch.column("pair").to_numpy()
        heads = [*np.flatnonzero(pair < 0).tolist(), batch.num_rows]
        for begin, end in zip([0, *heads], heads):  # rows before the first head belong to the batch before
            if begin < end and pair[begin] < 0:
                if head is not None:
                    yield _digest(head, counts, best)
                head, counts, best = batch.slice(begin, 1), [], []
                begin += 1
            counts.append(batch.column("count").slice(begin, end - begin).to_numpy())
            best.append(batch.column("best").slice(begin, end - begin).to_numpy(zero_copy_only=False))
    if head is not None:
        yield _digest(head, counts, best)


def _digest(head: pa.RecordBatch, counts: list[np.ndarray], best: list[np.ndarray]) -> pa.RecordBatch:
    count, best_ = np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*best, np.zeros(0, bool)])
    size, raw = head.column("link_bytes")[0].as_py(), head.column("links")[0].as_py()
    links = np.frombuffer(pa.Codec("zstd").decompress(raw, size, asbytes=True) if size else b"",
                          np.uint16 if len(count) <= _SIDE else np.uint32)
    docs = pa.ipc.read_record_batch(pa.py_buffer(head.column("docs")[0].as_py()), pa.schema(list(_DOC_COLUMNS.items())))
    n_links = docs.column("n_links").to_numpy()
    ends = np.cumsum(n_links)

    def total(of: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(of[links].astype(np.int64))])
        return run[ends] - run[ends - n_links]

    *cols, digest = docs.columns
    return pa.RecordBatch.from_arrays([*cols, pa.array(total(best_)), pa.array(total(count)), digest],
                                      names=[c.split()[0] for c in DIGEST_SCHEMA.split(", ")])


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    if a_path and b_path:
        return a_path, b_path
    import public_tokenizers

    return a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def token_groups(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_stops, b_stops, link_a, link_b): the tokens of each text, the tokens of A
    and of B before the end of each group, and the places of linked tokens."""
    ready(docs.sparkSession)
    paths = _paths(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, n_a, n_b, a_ids, b_ids, al in _aligned(batches, paths):
            end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
            begin_a, begin_b = end_a - n_a, end_b - n_b
            groups, links = np.searchsorted(al.a_stops, end_a, side="right"), np.searchsorted(al.link_a, end_a, side="left")

            def lists(values, stops, base=None):
                stops = np.append(0, stops)
                values = values.astype(np.int32) - (0 if base is None else np.repeat(base, np.diff(stops)).astype(np.int32))
                return pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(values, pa.int32()))

            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), lists(a_ids, end_a), lists(b_ids, end_b), lists(al.a_stops, groups, begin_a),
                lists(al.b_stops, groups, begin_b), lists(al.link_a, links, begin_a), lists(al.link_b, links, begin_b)],
                names=[c.split()[0] for c in GROUP_SCHEMA.split(", ")])

    return _texts(docs).mapInArrow(tidy(run), GROUP_SCHEMA)


def _counted(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair in the corpus, and whether no other id of A has more with its id of B."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % _SIDE)
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    # A row for each id of B: at most 65,536.
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _block_table(docs: DataFrame, scratch: Scratch, a_path: str | None, b_path: str | None) -> tuple[DataFrame, DataFrame]:
    """Blocks as a table, and their distinct pairs (block, pair, n)."""
    blocks = _texts(docs).mapInArrow(tidy(_blocks(_paths(a_path, b_path))), BLOCK_SCHEMA)
    blocks = scratch.table(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    return blocks, blocks.select("block", "pairs", "pair_links").mapInArrow(tidy(_pairs), "block long, pair long, n long")


def linked_ids(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(a_id, b_id, count, best): how many links of the corpus hold each id pair."""
    _, pairs = _block_table(docs, Scratch(docs.sparkSession, "alignment"), a_path, b_path)
    return _counted(pairs).select((F.col("pair") / _SIDE).cast("int").alias("a_id"), (F.col("pair") % _SIDE).cast("int").alias("b_id"),
                                  "count", "best")


def alignment_digest(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document."""
    scratch = Scratch(ready(docs.sparkSession), "alignment")
    blocks, pairs = _block_table(docs, scratch, a_path, b_path)
    counts = scratch.table(_counted(pairs), "counts")
    payload = ("docs", "links", "link_bytes")
    kinds = dict(blocks.dtypes)
    back = pairs.select("block", "pair").join(counts, "pair").select(
        "block", "pair", "count", "best", *(F.lit(None).cast(kinds[c]).alias(c) for c in payload))
    heads = blocks.select("block", F.lit(-1).cast("long").alias("pair"), F.lit(0).cast("long").alias("count"),
                          F.lit(False).alias("best"), *payload)
    return heads.unionByName(back).repartition("block").sortWithinPartitions("block", "pair") \
        .mapInArrow(tidy(_digests), DIGEST_SCHEMA)
