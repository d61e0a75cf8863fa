"""The training-data queries: against DuckDB where SQL can express them, schema and rows otherwise."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "scripts"))

from check_oracle import compare, duck_connection  # noqa: E402

from shopstream.llm.oracle import LLM_ORACLE_SQL  # noqa: E402
from shopstream.llm.queries import LLM_QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS_OF = {"op3_passages": None, "op8_chat": None, "op12_neighbours": 20, "op13_whitening": 4}


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF, duck_connection(SF))
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLE_SQL) - set(ROWS_OF)))
def test_a_row_for_each_document(spark, sample_docs, name):
    got = LLM_QUERIES[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == \
        sorted(r.doc_id for r in sample_docs.select("doc_id").collect())


@pytest.mark.parametrize("name", ["op12_neighbours", "op13_whitening"])
def test_rows_for_each_vector(spark, name):
    """Their rows are named by vec_id: the queries' neighbours, and the components of every vector."""
    ids = [r.vec_id for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id").collect()]
    key, want = ("query_id", [i for i in ids if i % 20 == 0]) if name == "op12_neighbours" else ("vec_id", ids)
    got = LLM_QUERIES[name](spark, SF)
    assert sorted(r[key] for r in got.select(key).collect()) == sorted(i for i in want for _ in range(ROWS_OF[name]))


CONTRACT = {
    "op1_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op4_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_langid": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                        "near_edited double, near_next double",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_parity_join": "doc_id bigint, n_shingles bigint, component_id bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns(spark, name):
    have = dict(LLM_QUERIES[name](spark, SF).dtypes)
    for part in CONTRACT[name].split(", "):
        column, kind = part.split(" ")
        assert have[column] == kind
