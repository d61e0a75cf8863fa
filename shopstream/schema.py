"""Record shapes shared by every job.

The behavior record is the flat 8-field JSON message. The two serving tables
are what the streaming job and the daily batch job publish.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of the activity message.
BEHAVIOR = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("behavior_type", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("session_id", T.StringType()),
    ]
)

BEHAVIOR_COLUMNS = [f.name for f in BEHAVIOR.fields]

# Behavior types that the reports single out.
CLICK = "click"
CART = "cart"
BUY = "buy"
FAV = "fav"

# The serving table written by the streaming job; key (window_start, window_end).
REALTIME_STATS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("pv", T.LongType()),
        T.StructField("uv", T.LongType()),
        T.StructField("sales", T.DoubleType()),
    ]
)
REALTIME_KEYS = ["window_start", "window_end"]

# The serving table written by the daily job; key report_date.
DAILY_REPORTS = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("total_sales", T.DoubleType()),
        T.StructField("top1_product", T.StringType()),
        T.StructField("top1_sales", T.DoubleType()),
        T.StructField("top2_product", T.StringType()),
        T.StructField("top2_sales", T.DoubleType()),
        T.StructField("top3_product", T.StringType()),
        T.StructField("top3_sales", T.DoubleType()),
        T.StructField("click_uv", T.LongType()),
        T.StructField("cart_uv", T.LongType()),
        T.StructField("buy_uv", T.LongType()),
    ]
)
DAILY_KEYS = ["report_date"]

# DDL for a relational serving store. Unlike the original table definition the
# realtime table gets a primary key, which a keyed upsert needs.
REALTIME_STATS_DDL = """CREATE TABLE realtime_stats (
    window_start TIMESTAMP NOT NULL,
    window_end TIMESTAMP NOT NULL,
    pv BIGINT,
    uv BIGINT,
    sales DOUBLE,
    PRIMARY KEY (window_start, window_end)
)"""

DAILY_REPORTS_DDL = """CREATE TABLE daily_reports (
    report_date DATE NOT NULL PRIMARY KEY,
    total_sales DOUBLE,
    top1_product VARCHAR(50),
    top1_sales DOUBLE,
    top2_product VARCHAR(50),
    top2_sales DOUBLE,
    top3_product VARCHAR(50),
    top3_sales DOUBLE,
    click_uv BIGINT,
    cart_uv BIGINT,
    buy_uv BIGINT
)"""
