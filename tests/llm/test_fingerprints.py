from __future__ import annotations

import hashlib
import random

import pytest

from shopstream.llm import fingerprints as fp


def _text(rng):
    return "".join(rng.choice(["a ", "b ", "c d ", "é ", "\n", "\n\n", "xyz "]) for _ in range(rng.randint(0, 30)))


def test_sums_are_homomorphic():
    rng = random.Random(1)
    for _ in range(300):
        a, b = _text(rng), _text(rng)
        text, sums = fp.edit(fp.Paragraphs(a), fp.Paragraphs(b))
        n = len(a)
        assert text == a[:n - n // 2] + b[:n // 2] and fp.fingerprint_hex(*sums) == fp.fingerprint(text)
        lines = a.split("\n")
        rng.shuffle(lines)
        assert fp.fingerprint("\n".join(lines)) == fp.fingerprint(a)
        assert fp.delete_paragraph(fp.insert_paragraph(fp.fingerprint(a), "q r s t"), "q r s t") == fp.fingerprint(a)


def test_multiplicity_counts():
    assert fp.fingerprint("a b\na b") != fp.fingerprint("a b") != fp.fingerprint("a  b")


def _brute(rows):
    """Rows in order of (id, nulls first); ties share a follower set, so tests avoid them."""
    out = {}
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[:n - n // 2] + following[:n // 2]
        out[doc_id] = (n, hashlib.sha256(edited.encode()).hexdigest(), fp.fingerprint(text), fp.fingerprint(edited))
    return out


def _got(docs):
    rows = fp.edited_fingerprints(docs).collect()
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in rows}, rows


@pytest.mark.parametrize("partitions", ["1", "4", "37"])
def test_sample_in_any_number_of_buckets(spark, sample_docs, sample_texts, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got, rows = _got(sample_docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(rows) == len(sample_texts) and got == _brute(sorted(sample_texts.items()))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


def test_edge_rows(make_docs):
    rows = [(None, "no id\nbut text"), (1, None), (2, ""), (3, "é" * 101), (5, "word " * 60_000), (9, "end")]
    got, _ = _got(make_docs(rows))
    assert got == _brute(rows)
    got, rows = _got(make_docs([(4, "only one\nhere")]))
    assert got == _brute([(4, "only one\nhere")]) and rows[0].near_next == 1.0
    same = fp.edited_fingerprints(make_docs([(7, "x y z")] * 5 + [(8, "x y z")])).collect()
    assert len(same) == 6 and len({r.fingerprint for r in same}) == 1 and all(r.near_next == 1.0 for r in same)
    assert fp.edited_fingerprints(make_docs([])).collect() == []


def test_likeness_cases():
    zero, some = fp.Paragraphs("").sums(), fp.Paragraphs("a b c d e f").sums()
    assert fp.likeness(zero, zero) == 1.0 and fp.likeness(zero, some) == 0.0 and fp.likeness(some, some) == 1.0
