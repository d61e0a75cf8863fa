"""shopstream: online-shop activity analytics on Spark DataFrames.

Main entry points::

    from shopstream import (
        build_session, decode_messages, window_stats, daily_report,
        read_raw_landing, read_warehouse, write_warehouse, upsert_files,
        start_realtime_stats, latest_windows, daily_series,
    )
"""

from shopstream.functions.jsonfns import decode_messages, encode_messages
from shopstream.operators.daily import (
    behavior_funnel,
    category_sales,
    daily_report,
    top_products,
    total_sales,
)
from shopstream.operators.windows import window_stats, with_event_time
from shopstream.plans.serving import daily_series, funnel_last, latest_windows
from shopstream.session import build_session
from shopstream.sources.files import (
    read_raw_landing,
    read_warehouse,
    write_raw_landing,
    write_warehouse,
)
from shopstream.sources.tables import upsert_files, upsert_jdbc
from shopstream.streaming.realtime import (
    read_message_stream,
    realtime_table_sink,
    start_raw_landing,
    start_realtime_stats,
)

__all__ = [
    "behavior_funnel", "build_session", "category_sales", "daily_report", "daily_series",
    "decode_messages", "encode_messages", "funnel_last", "latest_windows",
    "read_message_stream", "read_raw_landing", "read_warehouse", "realtime_table_sink",
    "start_raw_landing", "start_realtime_stats", "top_products", "total_sales",
    "upsert_files", "upsert_jdbc", "window_stats", "with_event_time", "write_raw_landing",
    "write_warehouse",
]
