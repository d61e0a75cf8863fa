from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]), with extra columns whose names operators use inside."""
    def make(rows, extra: bool = True):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else (None, None)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_COLUMNS)
        if extra:
            for name in ("row", "v", "h", "size", "k", "seed", "held_out", "position", "label", "lower_text", "S"):
                df = df.withColumn(name, df["doc_id"])
        return df.repartition(3)
    return make


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sample_texts(sample_docs):
    return {r.doc_id: r.text for r in sample_docs.select("doc_id", "text").collect()}
