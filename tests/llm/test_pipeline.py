"""The pipeline against plain versions of its stages, each over the stage's own input."""

from __future__ import annotations

import random
import re
import statistics
import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from shopstream.llm import langid, mixing
from shopstream.llm.queries import LLM_QUERIES
from .test_decontamination import _brute as contaminated
from .test_parity_join import _brute as components
from .test_token_files import _expected as tokens

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, sample_docs):
    benchmark = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = sample_docs
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == sample_docs.columns
        out[name] = [r for r in got.collect()]
        before = [r for r in docs.collect()]
        if name == "language_id":
            want = sorted(_recognised(before))
        elif name == "near_duplicates":
            want = sorted(i for i, _, c in components([(r.doc_id, r.text) for r in before]) if i == c)
        elif name == "decontamination":
            want = sorted(r[0] for r in contaminated([(r.doc_id, r.text) for r in before], benchmark) if not r[5])
        else:
            copies = {r.doc_id: r.copies for r in mixing.taken_words(docs).collect()}
            want = sorted(i for i, n in copies.items() for _ in range(n))
        assert sorted(r.doc_id for r in out[name]) == want, name
        docs = spark.createDataFrame(out[name], sample_docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    want = tokens(sorted((r.doc_id, r.text) for r in out["mixing"]))
    assert sorted(tuple(r) for r in last.collect()) == sorted(want)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)


def _recognised(rows):
    """Documents with a letter and with enough four-byte n-grams that two training documents have."""
    grams = {}
    for r in rows:
        words = re.findall(rb"[a-z\x80-\xff]+", (r.text or "").lower().encode())
        grams[r.doc_id] = [g for w in words for g in [b"\0" + w + b"\0"] for g in [g[i:i + 4] for i in range(len(g) - 3)]]
    train = [r.doc_id for r in rows if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    count = Counter(g for i in train for g in set(grams[i]))
    share = {i: sum(count[g] >= 2 for g in grams[i]) for i in grams}
    shares = sorted(share[i] / len(grams[i]) for i in train if grams[i])
    median = statistics.median(shares)
    for r in rows:
        if re.search(r"[^\W\d_]", r.text or "") and (share[r.doc_id] + 8 * median) / (len(grams[r.doc_id]) + 8) >= 0.5 * median:
            yield r.doc_id


def test_filters_keep_most_documents(spark, sample_docs):
    kept = corpus_pipeline.language_id(spark, sample_docs, SF).count()
    assert kept >= 0.97 * sample_docs.count()


def test_edge_tables(spark, make_docs):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "the words of the text are here and there", "en", None),
            (4, "the words of the text are here and there", "en", "b"), (4, "the words of the text are here and there", "en", "b"),
            (None, "the and of that with for are", "en", "b"), (5, "long " * 20_000, "en", "c")]
    for docs in (make_docs(rows), make_docs([])):
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema) if name != "token_files" \
                else stage(spark, docs, SF)
            assert name == "token_files" or docs.columns == before
        docs.collect()


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in LLM_QUERIES}) == list(range(1, 14))


def test_what_language_id_drops_is_in_no_token_file(spark, sample_docs, tmp_path, monkeypatch):
    rng = random.Random(10)
    junk = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(60)) for _ in range(20)]
    bad = [*junk, "123 456 !?", "", None]
    planted = spark.createDataFrame([(10 ** 6 + i, t, None, "src1", len(t or "")) for i, t in enumerate(bad)],
                                    "doc_id long, text string, lang string, source string, n_chars long")
    sample_docs.unionByName(planted.select(*[planted[c].cast(t) for c, t in sample_docs.dtypes])) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = lambda: {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    with_stage = ids()
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:])
    without = ids()
    assert not {i for i in with_stage if i >= 10 ** 6} and len(with_stage) > 50
    assert len({i for i in without if i >= 10 ** 6}) >= 5  # as many as the mix takes of them


def test_language_id_names_the_language_of_every_text(spark, sample_docs):
    """Each text that stays has the language that op6's labels give it, whatever language it came with."""
    wrong = sample_docs.withColumn("lang", F.expr("CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 "
                                                  "THEN if(doc_id % 2 = 0, 'xx', null) ELSE lang END"))
    found = {r.doc_id: r.lang_pred for r in langid.detect(wrong, langid.train(wrong)).collect()}
    got = corpus_pipeline.language_id(spark, wrong, SF)
    assert got.schema == wrong.schema
    rows = {r.doc_id: r for r in got.collect()}
    assert {i: r.lang for i, r in rows.items()} == {i: found[i] for i in rows}
    given = {r.doc_id: r for r in sample_docs.collect()}
    held = [r for i, r in rows.items() if zlib.crc32(str(i).encode()) % 3 == 1 and given[i].lang]
    assert len(held) > 30 and sum(r.lang == given[r.doc_id].lang for r in held) > 0.95 * len(held)
    assert all(r[c] == given[i][c] for i, r in rows.items() for c in sample_docs.columns if c != "lang")
