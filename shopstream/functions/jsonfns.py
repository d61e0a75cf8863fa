"""JSON message encode / decode.

Decoding is PERMISSIVE with the fixed schema: unknown fields are dropped, a
missing field or one of the wrong type becomes null for that field only, and a
message that is not JSON becomes a row of nulls.

With ``keep_corrupt`` the parser also hands over what it could not read, so that jobs can
count and keep it instead of losing it silently: ``unreadable`` marks messages of which
no field could be read, ``damaged`` those that lost some fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.schema import BEHAVIOR, BEHAVIOR_COLUMNS

#: Text of a message that could not be read as a whole, null otherwise.
CORRUPT = "_corrupt_record"
BEHAVIOR_AND_CORRUPT = T.StructType([*BEHAVIOR.fields, T.StructField(CORRUPT, T.StringType())])


def decode_messages(messages: DataFrame, value_col: str = "value", keep_corrupt: bool = False) -> DataFrame:
    """``value`` (binary or string) -> the 8 behavior columns, with ``keep_corrupt`` also ``CORRUPT``.

    Other columns of ``messages`` (for example partition columns of a landing
    zone or a Kafka timestamp) are carried along after the behavior columns.
    """
    extra = [c for c in messages.columns if c != value_col]
    schema = BEHAVIOR_AND_CORRUPT if keep_corrupt else BEHAVIOR
    parsed = F.from_json(F.col(value_col).cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("data")
    return messages.select(parsed, *extra).select("data.*", *extra)


def unreadable() -> Column:
    """True for a decoded row without any field: the message was no JSON object, blank, or held none of the fields."""
    out = F.col(BEHAVIOR_COLUMNS[0]).isNull()
    for c in BEHAVIOR_COLUMNS[1:]:
        out = out & F.col(c).isNull()
    return out


def damaged() -> Column:
    """True for a decoded row (``keep_corrupt``) that lost some of its fields, for example to a wrong type."""
    return F.col(CORRUPT).isNotNull() & ~unreadable()


def encode_messages(behavior: DataFrame, value_col: str = "value") -> DataFrame:
    """The 8 behavior columns -> one JSON string per row (nulls omitted)."""
    return behavior.select(message_json().alias(value_col))


def message_json() -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in BEHAVIOR_COLUMNS]))


def publish_messages(behavior: DataFrame, bootstrap_servers: str, topic: str,
                     kafka_options: dict[str, str] | None = None) -> None:
    """Encode behavior rows and write them to a Kafka topic (batch).

    Needs the Kafka connector on the classpath.
    """
    writer = (
        encode_messages(behavior).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
    )
    for k, v in (kafka_options or {}).items():
        writer = writer.option(k, v)
    writer.save()
