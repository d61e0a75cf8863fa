"""Kafka source / sink wiring; skipped when the connector is not on the classpath."""

from __future__ import annotations

import pytest

from shopstream.streaming.realtime import read_message_stream


def _has_kafka(spark) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def test_kafka_source_shape(spark):
    if not _has_kafka(spark):
        pytest.skip("Kafka connector not on the classpath")
    df = read_message_stream(spark, bootstrap_servers="localhost:9", topic="user_behavior")
    assert df.isStreaming and df.columns == ["value", "arrival"]


def test_needs_a_source(spark):
    with pytest.raises(ValueError):
        read_message_stream(spark)
