from __future__ import annotations

import hashlib
import random
import re

import pytest

from shopstream.llm import decontamination as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def _windows(text):
    w = _words(text)
    return {tuple(w[i:i + 10]) for i in range(len(w) - 9)} if len(w) >= 10 else {tuple(w)} if w else set()


def _brute(docs, items):
    windows = [(i, x) for i, t in items for x in _windows(t)]
    out = []
    for doc_id, text in docs:
        w = _words(text)
        hit, found = set(), set()
        for item, x in windows:
            for p in range(len(w) - len(x) + 1):
                if tuple(w[p:p + len(x)]) == x:
                    hit.update(range(p, p + len(x)))
                    found.add(item)
        found = sorted(f for f in found if f is not None)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "é", "7x"]
    items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.choice([0, 2, 9, 10, 12, 25])))) for i in range(6)]
    docs = []
    for i in range(25):
        text = " ".join(rng.choices(vocabulary + ["zz"], k=rng.randint(0, 60)))
        if rng.random() < 0.6:
            w = rng.choice(items)[1].split()
            text += "! " + " ".join(w[rng.randint(0, 3):]).upper() + ". " + text
        docs.append((i, text))
    return docs, items


@pytest.mark.parametrize("seed", range(12))
def test_shard_against_brute_force(seed):
    docs, items = _random_case(seed)
    block = dc.BenchmarkBlock([(i, t.encode()) for i, t in items], 10)
    got = []
    for (doc_id, _), (n, spans, own, best) in zip(docs, dc.match_shard([t.encode() for _, t in docs], block)):
        names = sorted({block.items[k] for k in own})
        got.append((doc_id, n, sum(e - b for b, e in spans), len(names),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(spans)))
        if best:  # the longest match is one, word for word
            item, at, place, size = best
            d, t = _words(docs[doc_id][1]), _words(items[int(block.items[item])][1])
            assert d[place:place + size] == t[at:at + size] and size > 0
    assert sorted(got, key=repr) == _brute(docs, items)


def _tables(spark, make_docs, docs, items):
    return make_docs(docs), spark.createDataFrame(items, "item_id string, text string")


def test_blocks_of_the_benchmark_agree(spark, make_docs):
    docs, items = _random_case(99)
    d, b = _tables(spark, make_docs, docs, items)
    one = sorted((tuple(r) for r in dc.contamination_digest(dc.benchmark_matches(d, b)).collect()), key=repr)
    many = sorted((tuple(r) for r in dc.contamination_digest(dc.benchmark_matches(d, b, block_bytes=40)).collect()), key=repr)
    assert one == many == _brute(docs, items)
    kept = {r.doc_id for r in dc.remove_contaminated(d, b, block_bytes=40).collect()}
    assert kept == {r[0] for r in one if not r[5]}


def test_edge_rows(spark, make_docs):
    items = [("1", "one two three four five six seven eight nine ten eleven"), ("2", None), ("3", "..."), (None, "solo word"),
             ("5", "solo word"), ("5", "one two three four five six seven eight nine ten")]
    docs = [(1, None), (2, ""), (3, "x " * 30_000 + "Solo, WORD"), (None, items[0][1]), (4, "clean"), (4, "solo word")]
    d, b = _tables(spark, make_docs, docs, items)
    got = sorted((tuple(r) for r in dc.contamination_digest(dc.benchmark_matches(d, b)).collect()), key=repr)
    assert got == _brute(docs, items)
    assert dc.remove_contaminated(d, b).columns == d.columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.remove_contaminated(d, none).count() == len(docs)
    assert dc.benchmark_matches(make_docs([]), b).collect() == []
