from __future__ import annotations

import itertools
import re
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.llm import token_files as tf
from shopstream.llm import words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2 ** 64 - 1)), max_size=400))
def test_coding_round_trip(ids):
    words = tf.encode_ids(np.array(ids, np.uint64))
    assert tf.decode_ids(words, len(ids)).tolist() == ids


def _greedy(ids):
    """The coding, an id at a time."""
    words, i = [], 0
    while i < len(ids):
        for s, (width, count) in enumerate(zip(tf.WIDTHS.tolist(), tf.COUNTS.tolist())):
            part = ids[i:i + count]
            if max(part) < 1 << width:
                words.append(s | sum(x << (4 + k * width) for k, x in enumerate(part)))
                i += count
                break
        else:
            words += [tf.ESCAPE, ids[i]]
            i += 1
    return words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 300), st.integers(0, 60_000), st.integers(0, 2 ** 64 - 1)), max_size=400))
def test_coding_takes_the_most_ids_for_each_word(ids):
    assert tf.encode_ids(np.array(ids, np.uint64)).tolist() == _greedy(ids)


def test_blocks_can_be_decoded_alone():
    ids = np.random.default_rng(1).integers(0, 5000, 20_000).astype(np.uint64)
    words = tf.encode_ids(ids)
    offsets = tf.block_offsets(words).tolist() + [len(ids)]
    for b in (0, 3, len(offsets) - 2):
        part = words[b * tf.BLOCK_WORDS:(b + 1) * tf.BLOCK_WORDS]
        assert tf.decode_ids(part, offsets[b + 1] - offsets[b]).tolist() == ids[offsets[b]:offsets[b + 1]].tolist()


def test_small_ids_take_little_room():
    assert len(tf.encode_ids(np.ones(600, np.uint64))) == 10
    assert len(tf.encode_ids(np.full(4, 2 ** 63, np.uint64))) == 8  # an escape and a raw word each


TRICKY = ["", "  \n\t ", "a\x0bb\x0cc\x85d e", "I'm don't, can't.. 12345 é́", "a <|endoftext|> b",
          "<|ENDOFTEXT|>x", "<|startoftext|>y<|startoftext|>", "İ Σας ΑΣ",
          "ÀÉÞ× ßÿ a÷b Ö!! öß² wo½rd, ½,x’s it's",
          "w&&& x### 中文 \U0001f600 ‍", "abc<|endoftext|>d", "x " * 3000]


def test_word_cache_equals_whole_text_encoding(sample_texts):
    cache = tf.WordCache(tf.default_tokenizer(), limit=3000)  # small: starts anew many times
    texts = TRICKY + list(sample_texts.values())[:80]
    for group in (texts[:5], texts, texts[::-1]):
        ids, counts = cache.encode([t.encode() for t in group], 2)
        at = 0
        for t, n in zip(group, counts):
            assert ids[at:at + n].tolist() == cache.tokenizer.encode(t, add_special_tokens=False).ids + [2]
            at += n


def test_what_letters_and_marks_are():
    like = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+([!-&(-/:;=?@\[-`{-~]*)\Z")
    texts = [chr(c) for c in range(33, 0x250)] + ["\u4e2d", "\U0001f600", "\u20ac"]
    words = [(a + b + c).encode() for a in ("", "x", "\xe9", ",") for b in texts for c in ("", "y", "\xe0", "!!", "'")]
    length = np.array(list(map(len, words)))
    end = np.cumsum(length)
    plain, mid = tf._letters_then_marks(np.frombuffer(b"".join(words), np.uint8), end - length, end)
    want = [like.match(w) for w in words]
    assert plain.tolist() == [m is not None for m in want]
    assert [int(e - m) for e, m, p in zip(end, mid, plain) if p] == [len(m[1]) for m in want if m]


class _Counted:
    """A tokenizer that counts the words it is given."""

    def __init__(self, tokenizer):
        self.model, self._tokenizer, self.calls = self, tokenizer, 0

    def tokenize(self, word):
        self.calls += 1
        return self._tokenizer.model.tokenize(word)


def test_half_a_million_words_are_merged_once():
    cache = tf.WordCache(tf.default_tokenizer())
    cache.tokenizer = counted = _Counted(cache.tokenizer)
    words = ["".join(w) for w in itertools.product("abcdefghijkl", "aeiou", "klmnoprst", "aeiou", "bcdfghklmn", "aeiouxyzst")][:260_000]
    texts = [" ".join(w + mark for w in words[i::20]).encode() for mark in ("", ",") for i in range(20)]
    first = [cache.encode([t], 2) for t in texts]
    assert counted.calls == len(words) + 1  # and the comma
    again = [cache.encode([t], 2) for t in texts]
    assert counted.calls == len(words) + 1
    for (a, n), (b, m) in zip(first, again):
        assert a.tolist() == b.tolist() and n.tolist() == m.tolist()


def _peak(step) -> int:
    """Most bytes that ``step`` holds at a time."""
    tracemalloc.start()
    try:
        step()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_hashing_a_slice_holds_little_beside_its_words():
    data = b"a word of some length " * 100_000
    words._POWERS.clear()
    assert _peak(lambda: words.word_spans(data)) < 14 * len(data)


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    texts = [b"", b" ", b"x" * 700, b"one two  three\n" + b"y" * 90 + b" end", b"z " * 500]
    want = words.word_hashes(texts)
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    monkeypatch.setattr(words, "_POWERS", {})
    for got, expected in zip(words.word_hashes(texts), want):
        assert got.tolist() == expected.tolist()
    spans = [words.word_spans(w)[3][0] for t in texts for w in t.split()]
    assert spans == want[0].tolist()


def test_a_task_encodes_a_batch_in_little_memory(monkeypatch):
    rng = np.random.default_rng(3)
    text = [" ".join(f"{chr(97 + a)}{chr(97 + b)}o{chr(97 + c)}" for a, b, c in rng.integers(0, 26, (2000, 3))) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": text})
    monkeypatch.setattr(tf.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    words._POWERS.clear()
    tf.word_cache.cache_clear()
    run = tf._pages(tf.default_tokenizer(), tf.END_ID, tf.PAGE_IDS)
    peak = _peak(lambda: [None for _ in run(iter([batch]))])
    assert peak < 60 << 20  # 5 MB of text


def test_long_and_many_new_words_equal_whole_text_encoding(monkeypatch):
    monkeypatch.setattr(tf, "LEARN_WORDS", 7)
    monkeypatch.setattr(tf, "LEARN_BYTES", 20)
    cache = tf.WordCache(tf.default_tokenizer(), limit=300)
    text = " ".join([*TRICKY, "\u4e2d\u6587" * 40, *(f"{i} w{i} <|x{i}" for i in range(200))])
    for _ in range(2):
        ids, counts = cache.encode([text.encode()], 2)
        assert ids.tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids + [2] and counts.tolist() == [len(ids)]


def _expected(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tf.default_tokenizer())
    out, start = [], 0
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_digests_of_the_sample(spark, sample_docs, sample_texts):
    got = sorted(tuple(r) for r in tf.token_file_digests(sample_docs).collect())
    assert got == _expected(sorted(sample_texts.items()))


def test_edge_rows(make_docs):
    docs = make_docs([(5, None), (3, ""), (9, "long " * 50_000), (7, "tie"), (7, "tie"), (None, "no id"), (1, "a b")])
    got = sorted((tuple(r) for r in tf.token_file_digests(docs).collect()), key=lambda r: r[1])
    assert got == _expected([(None, "no id"), (1, "a b"), (3, ""), (5, None), (7, "tie"), (7, "tie"), (9, "long " * 50_000)])


def test_ids_are_read_back(make_docs, tmp_path):
    path = f"file://{tmp_path}/set"
    tf.write_token_files(make_docs([(1, "one two"), (2, None)]), path, tf.default_tokenizer(), page_ids=2)
    rows = sorted(tuple(r) for r in tf.read_token_files(make_docs([]).sparkSession, path).collect())
    assert [(r[0], r[1]) for r in rows] == [(1, 0), (2, 3)] and rows[0][2][-1] == 2 and rows[1][2] == [2]


def test_empty_table(make_docs):
    assert tf.token_file_digests(make_docs([])).collect() == []


@pytest.mark.parametrize("hot", [5000])
def test_one_id_on_a_third_of_the_rows(make_docs, hot):
    docs = make_docs([(7, "same text")] * hot + [(i, f"t {i}") for i in range(hot, 2 * hot)])
    rows = tf.token_file_digests(docs).collect()
    assert len(rows) == 2 * hot and len({r.start for r in rows}) == 2 * hot
