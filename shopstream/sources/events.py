"""Adapter: the shared ``events`` table -> behavior rows.

The test tables carry generic product events; this maps them onto the activity
message so every job can run on them (see FIXTURES.md section 5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.timefns import ntz_epoch_millis
from shopstream.schema import BUY

# event_type -> behavior_type. Unknown types pass through unchanged.
EVENT_TYPE_TO_BEHAVIOR = {
    "click": "click",
    "view": "fav",
    "signup": "cart",
    "purchase": "buy",
}


# Columns of the shared events table.
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with its declared schema (no footer-based inference)."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def behavior_from_events(events: DataFrame) -> DataFrame:
    """One behavior row per event, in the 8-column message shape."""
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_TO_BEHAVIOR.items() for x in kv])
    # Parse props once; item and category both derive from k.
    keyed = events.select(
        "user_id", "ts", "value",
        F.from_json(F.col("props"), "k BIGINT").getField("k").alias("k"),
        F.coalesce(mapping[F.col("event_type")], F.col("event_type")).alias("behavior_type"),
    )
    k = F.col("k")
    behavior_type = F.col("behavior_type")
    is_buy = behavior_type == F.lit(BUY)
    return keyed.select(
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("i_"), k.cast("string")).alias("item_id"),
        F.concat(F.lit("c_"), (k % 10).cast("string")).alias("category_id"),
        behavior_type.alias("behavior_type"),
        F.when(is_buy, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("quantity"),
        F.when(is_buy, F.col("value")).otherwise(F.lit(0.0)).cast("double").alias("amount"),
        ntz_epoch_millis("ts").alias("timestamp"),
        F.lit(None).cast("string").alias("session_id"),
    )


def load_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior_from_events(load_events(spark, sf_dir))
