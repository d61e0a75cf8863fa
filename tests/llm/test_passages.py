from __future__ import annotations

import random

import numpy as np
import pytest

from shopstream.llm import passages as ps


def _chain_score(x, y, chain):
    s = float(ps.K)
    for a, b in zip(chain, chain[1:]):
        s += ps.K - ps.GAP * ((x[b] - x[a]) + (y[b] - y[a]))
    return s


@pytest.mark.parametrize("seed", range(15))
def test_chains_against_a_quadratic_version(seed):
    rng = np.random.default_rng(seed)
    n = 40
    x = np.sort(rng.integers(0, 120, n))
    y = rng.integers(0, 120, n)
    best = np.full(n, float(ps.K))
    for i in range(n):
        prior = [best[j] - ps.GAP * ((x[i] - x[j]) + (y[i] - y[j])) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
        best[i] = ps.K + max([0.0, *prior])
    chains = ps.chain_anchors(x, y)
    assert sorted(np.concatenate(chains).tolist()) == list(range(n))  # each anchor once
    for c in chains:
        assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
    assert abs(_chain_score(x, y, chains[0]) - best.max()) < 1e-9


@pytest.mark.parametrize("seed", range(5))
def test_equal_words_of_a_gap_against_a_plain_version(seed):
    rng = np.random.default_rng(seed)
    for _ in range(300):
        a, b = (rng.integers(0, 4, int(rng.integers(0, 9))).astype(np.uint32) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (a[i] == b[j]))
        assert ps._edit_matches(a, b) == best[-1, -1]


def test_every_long_run_has_a_seed():
    rng = np.random.default_rng(3)
    for n in (8, 22, 23, 24, 100, 500):
        h = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        at, _ = ps.seeds_of(h)
        for begin in range(0, n - ps.K - ps.WINDOW + 2):
            inside = (at >= begin) & (at + ps.K <= begin + ps.K + ps.WINDOW - 1)
            assert inside.any()
        assert len(at)


@pytest.mark.parametrize("seed", range(5))
def test_words_beside_a_seed_never_hide_an_alignment(seed):
    """Where the carried words say that nothing goes on, aligning the whole texts gives no more words."""
    rng = np.random.default_rng(seed)
    mix = lambda x: ps.mix64(np.asarray(x, np.uint64) + np.uint64(1))
    ended = 0
    for _ in range(400):
        a = rng.integers(0, 10 ** 6, int(rng.integers(ps.K, 80)))
        at = int(rng.integers(0, len(a) - ps.K + 1))
        b = a.copy()
        for _ in range(int(rng.integers(0, 25))):  # other words, left out or added, not in the seed
            i = int(rng.integers(0, len(b)))
            if not at <= i < at + ps.K and len(b) == len(a):
                b[i] = rng.integers(0, 10 ** 6)
        head, tail = list(b[:at]), list(b[at + ps.K:])
        for side in (head, tail):
            if side and rng.random() < 0.5:
                del side[int(rng.integers(0, len(side)))]
        b = np.array(head + list(a[at:at + ps.K]) + tail)
        to = len(head)
        if rng.random() < 0.3:
            cut = int(rng.integers(0, 4))
            b = b[:to + ps.K + cut]
        ha, hb = mix(a), mix(b)
        left, right = ps.beside([ha, hb], [np.array([at]), np.array([to])])
        (bound,) = ps.bound_of_words(left[:1], left[1:], right[:1], right[1:])
        runs = ps._runs((ha >> np.uint64(32)).astype(np.uint32), (hb >> np.uint64(32)).astype(np.uint32), np.array([at]), np.array([to]), False)
        words = runs[-1][1] - runs[0][0]
        if bound != ps.UNBOUND:
            ended += 1
            assert words <= bound
    assert ended > 10


def _rows(docs):
    return ps.repeated_passages(docs).collect()


def _exact_runs(rows, n=51):
    """Documents that share a run of n words with an earlier one, by brute force."""
    first, found = {}, set()
    for doc_id, text in sorted(rows):
        w = (text or "").lower().split()
        runs = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        if any(r in first for r in runs):
            found.add(doc_id)
        for r in runs:
            first.setdefault(r, doc_id)
    return found


def test_sample_tables(sample_docs, sample_texts):
    got = _rows(sample_docs)
    assert _exact_runs(list(sample_texts.items())) <= {r.doc_id for r in got}
    assert len(set(got)) == len(got)
    words = {i: (t or "").lower().split() for i, t in sample_texts.items()}
    for r in got:
        assert r.other_id < r.doc_id and r.n_words >= 50 and r.identity >= 0.8
        a, b = words[r.doc_id][r.begin:r.end], words[r.other_id][r.other_begin:r.other_end]
        assert len(a) == r.end - r.begin and len(b) == r.other_end - r.other_begin
        assert len(set(a) & set(b)) >= 0.7 * len(set(a))


def _text(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def test_planted_passages_and_clean_documents(make_docs):
    rng = random.Random(1)
    exact, fuzzy, short = _text(rng, 55), _text(rng, 120), _text(rng, 40)
    rows = [(i, " ".join(_text(rng, 200))) for i in range(40)]
    for i in (100, 101, 102):
        rows.append((i, " ".join(_text(rng, 70) + exact + _text(rng, 30))))
    for i in (110, 111, 112):
        w = list(fuzzy)
        for k in rng.sample(range(len(w)), 4):
            w[k] = "changed"
        del w[rng.randrange(len(w))]
        rows.append((i, " ".join(_text(rng, 20) + w + _text(rng, 90))))
    for i in (120, 121):
        rows.append((i, " ".join(_text(rng, 50) + short + _text(rng, 50))))
    got = _rows(make_docs(rows))
    assert {(r.doc_id, r.other_id) for r in got} >= {(101, 100), (102, 100), (111, 110)}
    assert 112 in {r.doc_id for r in got}
    named = {r.doc_id for r in got} | {r.other_id for r in got}
    assert named == {100, 101, 102, 110, 111, 112}
    r = next(r for r in got if r.doc_id == 101)
    assert (r.begin, r.end, r.n_words, r.identity) == (70, 125, 55, 1.0)
    assert all(r.n_words > 90 for r in got if r.doc_id >= 110)


def test_edge_rows(make_docs):
    rng = random.Random(2)
    p = " ".join(_text(rng, 60))
    long = " ".join(_text(rng, 20_000))
    rows = [(1, None), (2, ""), (3, p), (3, p), (4, p.upper()), (None, p), (5, "same " * 5000), (6, "same " * 5000), (7, long), (8, long),
            (9, "x y z " * 30)]
    got = {(r.doc_id, r.other_id): r for r in _rows(make_docs(rows))}
    assert set(got) == {(4, 3), (6, 5), (8, 7)}
    assert got[8, 7].n_words == 20_000 and got[4, 3].n_words == 60
    assert _rows(make_docs([])) == [] and _rows(make_docs([(1, p)])) == []


def test_a_passage_in_a_third_of_the_documents(make_docs):
    rng = random.Random(3)
    p = _text(rng, 70)
    rows = [(i, " ".join(_text(rng, 40) + (p if i % 3 == 0 else []) + _text(rng, 40))) for i in range(900)]
    got = _rows(make_docs(rows))
    assert {r.doc_id for r in got} == set(range(3, 900, 3))
    assert sum(r.other_id == 0 for r in got) > 290
    assert len(got) < 310  # a row each, not all pairs; few documents also share the word beside the passage


def test_two_passages_of_a_pair_at_several_gaps(make_docs):
    rng = random.Random(4)
    rows, want = [], {}
    cases = [(60, 20, 20), (60, 60, 60), (60, 75, 60), (60, 0, 90), (60, 150, 150), (300, 180, 180), (300, 400, 300), (300, 750, 750)]
    for n, (size, gap, other_gap) in enumerate(cases):
        first, second = _text(rng, size), _text(rng, size)
        rows.append((2 * n, " ".join(_text(rng, 40) + first + _text(rng, other_gap) + second + _text(rng, 40))))
        rows.append((2 * n + 1, " ".join(_text(rng, 30) + first + _text(rng, gap) + second + _text(rng, 50))))
        b, o = 30 + size + gap, 40 + size + other_gap
        if 2 * size >= 0.8 * (2 * size + max(gap, other_gap)):  # one passage with the gap inside
            want[2 * n + 1] = [(30, b + size, 40, o + size)]
        else:
            want[2 * n + 1] = [(30, 30 + size, 40, 40 + size), (b, b + size, o, o + size)]
    got = {}
    for r in sorted(_rows(make_docs(rows)), key=lambda r: r.begin):
        assert r.other_id == r.doc_id - 1 and r.identity >= 0.8
        got.setdefault(r.doc_id, []).append((r.begin, r.end, r.other_begin, r.other_end))
    assert got == want and [len(want[2 * n + 1]) for n in range(len(cases))] == [1, 2, 2, 2, 2, 2, 2, 2]


@pytest.mark.parametrize("seed", range(10))
def test_pieces_against_every_run_of_runs(seed):
    rng = np.random.default_rng(seed)
    runs, i, j = [], 0, 0
    for n in range(40):
        p, q = rng.integers(0, 12, 2).tolist() if n else (0, 0)
        size = int(rng.integers(3, 30))
        runs.append([i + p, i + p + size, j + q, j + q + size, 0])
        i, j = i + p + size, j + q + size
    found = [(min(runs[v][1] - runs[u][0], runs[v][3] - runs[u][2]))
             for u in range(40) for v in range(u, 40)
             if sum(r[1] - r[0] for r in runs[u:v + 1]) >= 0.8 * max(runs[v][1] - runs[u][0], runs[v][3] - runs[u][2])]
    got = ps._pieces(runs, 50, 0.8)
    assert max([min(q - p, v - u) for p, q, u, v, _ in got], default=0) == (max(found) if max(found) >= 50 else 0)
    for p, q, u, v, equal in got:
        assert equal >= 0.8 * max(q - p, v - u) - 1e-6
        assert equal == sum(r[1] - r[0] for r in runs if p <= r[0] and r[1] <= q)
    assert all(a[1] <= b[0] and a[3] <= b[2] for a, b in zip(got, got[1:]))


def test_passages_of_which_earlier_documents_have_the_halves(make_docs):
    rng = random.Random(6)
    rows, want = [], set()
    for n in range(50):
        p = _text(rng, 60)
        texts = [p[:30], p[30:], p, p]
        for k, part in enumerate(texts):
            rows.append((4 * n + k, " ".join(_text(rng, 40) + part + _text(rng, 40))))
        want.add((4 * n + 3, 4 * n + 2))
    got = {(r.doc_id, r.other_id) for r in _rows(make_docs(rows)) if r.n_words >= 60}
    assert len(want & got) >= 45


def test_texts_that_share_an_id(make_docs):
    rng = random.Random(7)
    p = _text(rng, 300)
    first, second, third = " ".join(p), " ".join(_text(rng, 400) + p), " ".join(_text(rng, 900))
    for turn in range(6):
        rows = [(1, first), (2, second), (2, third)]
        rng.shuffle(rows)
        got = [tuple(r) for r in _rows(make_docs(rows).repartition(turn + 1))]
        assert got == [(2, 1, 400, 700, 0, 300, 300, 300, 1.0)]
    assert [(r.doc_id, r.other_id, r.n_words) for r in _rows(make_docs([(5, first), (5, second)]))] == [(5, 5, 300)]
    many = [(1, first)] * 30 + [(2, second)] * 30
    assert [(r.doc_id, r.other_id, r.n_words) for r in _rows(make_docs(many))] == [(2, 1, 300)]


def test_common_seeds_are_dealt_to_buckets(make_docs, monkeypatch):
    """The same documents are found when every seed of a few documents counts as common."""
    monkeypatch.setattr(ps, "SAMPLE", 2)
    monkeypatch.setattr(ps, "COMMON", 8)
    monkeypatch.setattr(ps, "BUCKET", 16)
    rng = random.Random(8)
    p = _text(rng, 70)
    rows = [(i, " ".join(_text(rng, 40) + (p if i % 2 else []) + _text(rng, 40))) for i in range(300)]
    got = _rows(make_docs(rows))
    named = {r.doc_id for r in got} | {r.other_id for r in got}
    assert named == set(range(1, 300, 2)) and all(r.n_words >= 70 for r in got)
    assert len({r.doc_id for r in got}) >= 120  # but for the first of each bucket


def test_a_passage_inside_a_fuzzy_copy(make_docs):
    rng = random.Random(5)
    whole, added = _text(rng, 600), _text(rng, 60)
    rows = [(1, " ".join(_text(rng, 80) + added + _text(rng, 80))), (2, " ".join(whole)),
            (3, " ".join(whole[:300] + added + whole[300:]))]
    got = {(r.doc_id, r.other_id): (r.begin, r.end, r.other_begin, r.other_end) for r in _rows(make_docs(rows))}
    assert got == {(3, 2): (0, 660, 0, 600), (3, 1): (300, 360, 80, 140)}


def test_passages_whose_every_seed_other_documents_have(make_docs):
    """Parts of a passage that overlap, in documents before both that have all of it and between them."""
    rng = random.Random(9)
    rows, want = [], set()
    for n in range(50):
        p = _text(rng, 75)
        parts = [p[i:i + 30] for i in (0, 15, 30, 45)]
        for k, part in enumerate([*parts, p, *parts, p]):
            rows.append((10 * n + k, " ".join(_text(rng, 40) + part + _text(rng, 40))))
        want.add((10 * n + 9, 10 * n + 4))
    got = {(r.doc_id, r.other_id) for r in _rows(make_docs(rows)) if r.n_words >= 75}
    assert len(want & got) == 50


def test_an_equal_passage_in_the_range_of_a_fuzzy_one(make_docs):
    """Document 1 has all of 3 but for a word, with all its seeds; 2 has 60 words around that one as they are."""
    for turn in range(100):
        rng = random.Random(turn)
        whole = _text(rng, 160)
        first = [*whole[:80], "other", *whole[81:]]
        seeds = [set(ps.seeds_of(ps.word_hashes([" ".join(w).encode()])[0])[0].tolist()) for w in (whole, first)]
        second = _text(rng, 40) + whole[50:110] + _text(rng, 40)
        if {x for x in seeds[0] if 50 <= x <= 104} <= seeds[1] and not any(75 <= x <= 80 for x in seeds[0]):
            break
    else:
        raise AssertionError("no such text")
    # Words around: 50 equal words in a row and more are in document 1 too, on either side of the changed one.
    rows = [(1, " ".join(first)), (2, " ".join(second)), (3, " ".join(whole))]
    got = {(r.doc_id, r.other_id): (r.begin, r.end, r.identity) for r in _rows(make_docs(rows))}
    assert got[3, 1][:2] == (0, 160) and got[3, 2] == (50, 110, 1.0)


def _link_rows(docs, scratch):
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").selectExpr("cast(doc_id AS long) AS doc_id", "hash(text) AS th", "text")
    seeds = scratch.table(texts.mapInArrow(ps._seeds(ps.MIN_WORDS), ps.SEED_SCHEMA), "seeds")
    links = ps._dealt(seeds, scratch).repartition("seed", "bucket").sortWithinPartitions("seed", "bucket", "doc_id", "th", "pos") \
        .mapInArrow(ps._links, ps.LINK_SCHEMA)
    return sorted(tuple(r) for r in links.collect())


def test_links_of_common_seeds_are_those_of_the_whole_group(spark, make_docs, monkeypatch):
    """Buckets change no link, whatever is around the seeds, and no passage is lost at the begin of a bucket."""
    rng = random.Random(12)
    p, beside_ = _text(rng, 70), [_text(rng, 30) for _ in range(5)]
    rows = []
    for i in range(300):
        head, tail = rng.choice(beside_) if i % 3 else _text(rng, 20), rng.choice(beside_) if i % 4 else _text(rng, 20)
        body = p * (3 if i % 17 == 0 else 1) if i % 2 else _text(rng, 60)
        rows.append((i % 280, " ".join(_text(rng, 10) + head + body + tail)))  # some share an id
    rows += [(400, "same " * 300), (401, "same " * 200), (402, "same " * 400), *rows[:5]]
    docs = make_docs(rows)
    whole = _link_rows(docs, ps.Scratch(spark, "whole"))
    passages = sorted(map(tuple, _rows(docs)))
    monkeypatch.setattr(ps, "SAMPLE", 2)
    monkeypatch.setattr(ps, "COMMON", 4)
    for bucket in (4, 16):
        monkeypatch.setattr(ps, "BUCKET", bucket)
        scratch = ps.Scratch(spark, "dealt")
        assert _link_rows(docs, scratch) == whole
        assert spark.read.parquet(f"{scratch.root}/002-common").selectExpr("max(size(bounds))").first()[0] > 100 // bucket
    assert sorted(map(tuple, _rows(docs))) == passages
    found = {r[0] for r in passages}
    assert {i for i in range(3, 280, 2)} <= found  # 1 is the first
