"""The registered queries of the training-data operators, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopstream.llm import (alignment, chat, decontamination, fingerprints, langid, mixing, parity_join, passages, permutation_index,
                            quality, token_files, toxicity, whitening)
from shopstream.llm.common import documents, ready


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(documents(spark, sf_dir))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination_digest(decontamination.benchmark_matches(docs, benchmark))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights, _ = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, weights)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.detect(docs, langid.train(docs))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ready(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.repair_conversations(turns)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.link_components(documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(documents(spark, sf_dir))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest_neighbours(ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_mixing": op2_mixing,
    "op3_passages": op3_passages,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_fingerprints": op7_fingerprints,
    "op8_chat": op8_chat,
    "op9_toxicity": op9_toxicity,
    "op10_parity_join": op10_parity_join,
    "op11_alignment": op11_alignment,
    "op12_neighbours": op12_neighbours,
    "op13_whitening": op13_whitening,
}
