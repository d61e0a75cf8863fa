from __future__ import annotations

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shopstream.llm import alignment as al

PIECES = [" ", "  ", "\n", "\t", "a", "The", "ing", "'s", "é", "ß", "日本", "🙂", "​", "\x85", "\x1c", "12", "-", "...",
          "<|endoftext|>", "<s>", "<0x41>", "́", "हिन्दी", "\r\n", " x ", "᠎", "　", "\x00", "ﬁ", "▁"]


@pytest.fixture(scope="module")
def tokens():
    return al.Tokens(*al._paths(None, None))


def _random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def _plain_groups(a, b):
    """Tokens before the end of each group by the ends that both lists have."""
    common = sorted(set(a) & set(b))
    return [bisect.bisect_right(a, c) for c in common], [bisect.bisect_right(b, c) for c in common]


def _plain_links(a, b):
    """Token pairs whose byte ranges overlap, over all pairs."""
    start_a, start_b = [0, *a[:-1]], [0, *b[:-1]]
    return [(i, j) for i in range(len(a)) for j in range(len(b)) if start_a[i] < b[j] and start_b[j] < a[i]]


@pytest.mark.parametrize("seed", range(40))
def test_alignment_against_sets_and_all_pairs(seed):
    rng = random.Random(seed)
    total = rng.randrange(1, 150)
    share = rng.choice([0.0, 0.02, 0.2, 0.6])  # ends that only one side has: long and short one-to-one runs
    both = {i for i in range(1, total) if rng.random() < 0.5} | {total}
    a, b = (sorted(both | {i for i in range(1, total) if rng.random() < share}) for _ in range(2))
    got = al.align(a, b)
    assert (got.a_stops.tolist(), got.b_stops.tolist()) == _plain_groups(a, b)
    assert list(zip(got.link_a.tolist(), got.link_b.tolist())) == _plain_links(a, b)


def test_alignment_of_nothing_and_of_one_long_run():
    assert len(al.align([], []).a_stops) == 0
    got = al.align(list(range(1, 1001)), list(range(1, 1001)))
    assert got.link_a.tolist() == got.link_b.tolist() == list(range(1000))


def test_units_give_the_ids_of_whole_texts(tokens):
    texts = _random_texts(3000) + [" ", "  ", "\n", " a", "a ", " a  b  ", "x\n y"]
    (a, b), (n_a, n_b) = tokens.encode(texts)
    parts = list(zip(np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1])))
    assert len(parts) == len(texts)
    without = 0
    for (x, y), want in zip(parts, tokens.whole(texts)):
        without += want is None
        assert (x.tolist(), y.tolist()) == (([], []) if want is None else (want[0].tolist(), want[1].tolist()))
    assert 0 < without < len(texts)  # texts with U+2581 have no tokens


def _plain_digests(tokens, rows):
    """The contract's columns, word for word, from whole texts."""
    per, links = [], Counter()
    for doc_id, text in rows:
        pair = tokens.whole([text])[0] if text else None
        if pair is None:
            per.append((doc_id, None))
            continue
        a, b = (p.tolist() for p in pair)
        ends_a, ends_b = np.cumsum(tokens.a_size[a]).tolist(), np.cumsum(tokens.b_size[b]).tolist()
        stops = list(zip([(0, 0), *zip(*_plain_groups(ends_a, ends_b))], zip(*_plain_groups(ends_a, ends_b))))
        text = ";".join(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])) for (i, j), (k, m) in stops)
        own = [(a[i], b[j]) for i, j in _plain_links(ends_a, ends_b)]
        links.update(own)
        per.append((doc_id, (len(a), len(b), len(stops), own, hashlib.sha256(text.encode()).hexdigest())))
    most = {}
    for (_, b), n in links.items():
        most[b] = max(n, most.get(b, 0))
    return [(doc_id, 0, 0, 0, 0, 0, 0, "") if p is None else
            (doc_id, p[0], p[1], p[2], len(p[3]), sum(links[x] == most[x[1]] for x in p[3]), sum(links[x] for x in p[3]), p[4])
            for doc_id, p in per]


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def test_digests_against_a_plain_version(make_docs, tokens, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_BYTES", 500)
    rows = [(i, t) for i, t in enumerate(_random_texts(120, seed=2))]
    rows += [(500, None), (501, ""), (None, "no id here"), (None, None), (7, "the same id"), (7, "the same id"), (502, "ab " * 300)]
    got = [tuple(r) for r in al.alignment_digest(make_docs(rows)).collect()]
    assert _order(got) == _order(_plain_digests(tokens, rows))


def test_digests_of_many_batches_and_a_very_long_text(make_docs, tokens, sample_texts):
    rows = [(i, t) for i, t in sample_texts.items() if t and len(t) < 3000][:60] + [(10 ** 6, "longer texts " * 40_000)]
    got = {r.doc_id: r for r in al.alignment_digest(make_docs(rows)).collect()}
    short = {r[0]: r for r in _plain_digests(tokens, rows[:-1])}
    long = got[10 ** 6]
    assert long.n_a == long.n_b == long.n_groups == long.n_links == 80_000 + (long.n_a - 80_000)
    assert all(tuple(got[i])[1:5] == short[i][1:5] and got[i].groups_sha256 == short[i][7] for i in short)


def test_a_unit_is_aligned_once(monkeypatch):
    aligned, plain = [], al.align
    monkeypatch.setattr(al, "align", lambda a, b: aligned.append(len(a)) or plain(a, b))
    al._tokens.cache_clear()
    texts = ["longer texts disagreeably " * 2_000] * 3
    batch = pa.record_batch([pa.array(range(3), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    rows = list(al._blocks(al._paths(None, None))(iter([batch])))
    assert len(rows) == 1 and sum(aligned) < 100


def test_a_full_cache_keeps_the_units_used_most(monkeypatch):
    tokens, learned = al.Tokens(*al._paths(None, None), limit=40), []
    plain = tokens.whole
    monkeypatch.setattr(tokens, "whole", lambda texts: learned.extend(texts) or plain(texts))
    rows = [(i, f"often seen here {i} {i * 7919}x {t}") for i, t in enumerate(_random_texts(200, seed=3))] + [(200, "short")]
    got, links = [], []
    for i, text in rows:
        (n_a, n_b, n_groups, n_links), pairs, digest = tokens.linked([text])
        assert len(tokens.text) == len(tokens.known) == len(tokens.uses) and int(n_links[0]) == len(pairs)
        got.append((i, *(int(n[0]) for n in (n_a, n_b, n_groups, n_links)), digest[0]))
        links.append(Counter(pairs.tolist()))
    want = _plain_digests(tokens, rows)
    assert got == [(*r[:5], r[7]) for r in want]
    assert sum(sum(c.values()) for c in links) == sum(r[4] for r in want)
    count = sum(links, Counter())
    assert [sum(count[p] * n for p, n in c.items()) for c in links] == [r[6] for r in want]
    learned_before = learned[:len(learned) - len(rows)]  # without the plain version's own calls
    assert sum("often" in t.split() for t in learned_before if "\u2581" not in t) <= 2


def test_units_of_many_characters_do_not_fill_the_cache(tokens, monkeypatch):
    monkeypatch.setattr(al, "UNIT_CHARS", 1000)
    own = al.Tokens(*al._paths(None, None))
    for i in range(20):
        text = f"{i}" * 600
        (a, b), _ = own.encode([text])
        want = tokens.whole([text])[0]
        assert (a.tolist(), b.tolist()) == (want[0].tolist(), want[1].tolist())
        assert len(own.known) <= 2


def test_no_rows(make_docs):
    assert al.alignment_digest(make_docs([])).collect() == []
    assert [tuple(r) for r in al.alignment_digest(make_docs([(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_groups_and_counts_as_tables(make_docs, tokens):
    rows = [(1, "tokenizers disagree here"), (2, ""), (3, "and here, disagreeably")]
    docs = make_docs(rows)
    links = Counter()
    for r in al.token_groups(docs).collect():
        text = dict(rows)[r.doc_id]
        if not text:
            assert list(map(len, r[1:])) == [0] * 6
            continue
        a, b = tokens.whole([text])[0]
        assert (r.a_ids, r.b_ids) == (a.tolist(), b.tolist())
        ends = [np.cumsum(s).tolist() for s in (tokens.a_size[a], tokens.b_size[b])]
        assert (r.a_stops, r.b_stops) == _plain_groups(*ends)
        assert list(zip(r.link_a, r.link_b)) == _plain_links(*ends)
        links.update((r.a_ids[i], r.b_ids[j]) for i, j in zip(r.link_a, r.link_b))
    got = {(r.a_id, r.b_id): (r["count"], r.best) for r in al.linked_ids(docs).collect()}
    most = {}
    for (_, b), n in links.items():
        most[b] = max(n, most.get(b, 0))
    assert got == {k: (n, n == most[k[1]]) for k, n in links.items()}
