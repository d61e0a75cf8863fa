"""Named queries over the shared test tables.

Every query takes ``(spark, sf_dir)``, reads the ``events`` table of that
directory (or data Spark derives from it) and returns a DataFrame whose columns
match the SQL statement of the same name in ``shopstream.plans.oracle``.
Timestamps leave as TIMESTAMP_NTZ holding UTC wall-clock time, so the result
does not depend on the session time zone.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream.functions.jsonfns import decode_messages, encode_messages, message_json
from shopstream.functions.timefns import event_time, utc_day, utc_wall_clock
from shopstream.operators import daily
from shopstream.operators.windows import window_stats, with_event_time
from shopstream.plans.jobs import run_daily
from shopstream.plans import oracle, serving
from shopstream.schema import BEHAVIOR_COLUMNS, DAILY_KEYS, REALTIME_KEYS
from shopstream.session import scratch_path
from shopstream.sources import files
from shopstream.sources.events import load_behavior
from shopstream.sources.tables import list_names, move_path, read_serving_files, upsert_files
from shopstream.streaming.realtime import (
    read_message_stream,
    realtime_table_sink,
    start_pane_stats,
    start_raw_landing,
    start_realtime_stats,
    start_side_rows,
)

#: Days that the dated reads ask for.
DATED_DAYS = 3

Query = Callable[[SparkSession, str], DataFrame]


def _ntz_windows(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "window_start": utc_wall_clock("window_start"),
            "window_end": utc_wall_clock("window_end"),
        }
    )


def q_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pv / exact uv / sales per 5-minute window sliding by 1 minute."""
    return _ntz_windows(window_stats(load_behavior(spark, sf_dir)))


def q_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time derived from epoch milliseconds, whole seconds."""
    timed = with_event_time(load_behavior(spark, sf_dir))
    return timed.select(
        "user_id", "behavior_type", "timestamp", utc_wall_clock("event_time").alias("event_time")
    )


def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behavior rows encoded as JSON messages and decoded with the fixed schema."""
    return decode_messages(encode_messages(load_behavior(spark, sf_dir)))


def q_daily_total_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.total_sales(load_behavior(spark, sf_dir))


def q_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.top_products(load_behavior(spark, sf_dir))


def q_behavior_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.behavior_funnel(load_behavior(spark, sf_dir))


def q_category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.category_sales(load_behavior(spark, sf_dir))


def q_daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_report(load_behavior(spark, sf_dir))


def _uv_checked(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Window stats whose approximate uv is held against the exact count of the same rows.

    ``uv`` is the exact count where the estimate is within the estimator's bound (off by one at most under ten
    users, else by three standard errors of 0.05), and the estimate itself where it is not. ``uv_unbiased``
    says whether all estimates together are within 2 % of all exact counts. An estimate that is always off
    by one, or always the same, passes the first and fails the second.
    """
    other = exact.select(F.col("window_start").alias("exact_start"), F.col("uv").alias("exact_uv"))
    both = approx.join(other, F.col("window_start") == F.col("exact_start"), "left")
    bound = F.when(F.col("exact_uv") < 10, F.lit(1.0)).otherwise(F.col("exact_uv") * 0.15)
    close = F.coalesce(F.abs(F.col("uv") - F.col("exact_uv")) <= bound, F.lit(False))
    total = both.agg((F.abs(F.sum("uv") - F.sum("exact_uv")) <= F.sum("exact_uv") * 0.02).alias("unbiased"))
    return both.select(
        "window_start", "window_end", "pv", F.when(close, F.col("exact_uv")).otherwise(F.col("uv")).alias("uv"),
        total.scalar().alias("uv_unbiased"), "sales")


def q_window_stats_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same windows with the approximate (HyperLogLog) uv the stream uses, held against the exact count."""
    behavior = load_behavior(spark, sf_dir)
    return _ntz_windows(_uv_checked(window_stats(behavior, exact_uv=False), window_stats(behavior)))


def q_window_stats_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate uv from per-minute HLL sketches unioned per window (opt-in
    estimator; each row is aggregated once, not once per window), held against the exact count."""
    behavior = load_behavior(spark, sf_dir)
    return _ntz_windows(_uv_checked(
        window_stats(behavior, exact_uv=False, strategy="panes"), window_stats(behavior)))


def q_window_stats_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with Spark's own window() plan (every row copied into its
    five windows) instead of pane pre-aggregation; same result."""
    return _ntz_windows(window_stats(load_behavior(spark, sf_dir), strategy="expand"))


def _stored_windows(spark: SparkSession, sf_dir: str) -> str:
    """Window stats upserted into a serving table, as the realtime job keeps it."""
    table = scratch_path(spark, "serving-windows")
    rows = window_stats(load_behavior(spark, sf_dir))
    upsert_files(rows.withColumn("window_day", utc_day("window_start")), table, REALTIME_KEYS, "window_day")
    return table


def _stored_reports(spark: SparkSession, sf_dir: str) -> str:
    table = scratch_path(spark, "serving-reports")
    rows = q_daily_report(spark, sf_dir).withColumn("report_month", F.date_format("report_date", "yyyy-MM"))
    upsert_files(rows, table, DAILY_KEYS, "report_month")
    return table


def q_latest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard view: the last 30 windows of the serving table, oldest first, labelled HH:mm-HH:mm."""
    newest = serving.newest_rows(spark, _stored_windows(spark, sf_dir), serving.REALTIME_POINTS)
    return serving.latest_windows(_ntz_windows(newest))


def q_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard view: the last 30 daily reports of the serving table, oldest first, formatted."""
    return serving.daily_series(serving.newest_rows(spark, _stored_reports(spark, sf_dir), serving.DAILY_POINTS))


def q_funnel_last7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard view: users per step over the last 7 days of the serving table."""
    return serving.funnel_last(serving.newest_rows(spark, _stored_reports(spark, sf_dir), serving.FUNNEL_POINTS))


def _warehouse(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "warehouse")
    day = F.date_format(utc_day(event_time("timestamp")), "yyyy-MM-dd")
    files.write_warehouse(load_behavior(spark, sf_dir).withColumn("dt", day), base, cluster_days=True)
    return base


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behavior rows written to the dt-partitioned warehouse and read back."""
    return files.read_warehouse(spark, _warehouse(spark, sf_dir)).select(*BEHAVIOR_COLUMNS, "dt")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Messages landed as JSON lines under dt/hour.

    The test tables have no arrival clock, so event time picks the directory.
    """
    base = scratch_path(spark, "landing")
    files.write_raw_landing(
        load_behavior(spark, sf_dir).select(message_json().alias("value"), "timestamp"),
        base,
        arrival=event_time("timestamp"),
    )
    return base


def _first_days(spark: SparkSession, sf_dir: str, n: int = DATED_DAYS) -> list[str]:
    """The first ``n`` days of the table's time, whether they have rows or not."""
    low = load_behavior(spark, sf_dir).agg(F.min(utc_day(event_time("timestamp")))).first()[0]
    return [(low + datetime.timedelta(days=i)).isoformat() for i in range(n)] if low else []


def q_raw_landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed as JSON lines under dt/hour, scanned with the fixed schema."""
    return files.read_raw_landing(spark, _landed(spark, sf_dir))


def q_landing_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nightly run's read of the landing: given days only, the other folders are not listed."""
    base = _landed(spark, sf_dir)
    return files.read_raw_landing(spark, base, dates=_first_days(spark, sf_dir)).drop("hour")


def q_warehouse_day_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given days of the warehouse."""
    base = _warehouse(spark, sf_dir)
    return files.read_warehouse(spark, base, dates=_first_days(spark, sf_dir)).select(*BEHAVIOR_COLUMNS, "dt")


def _message_files(spark: SparkSession, sf_dir: str) -> str:
    """Behavior rows written as JSON-lines message files (a stream's input)."""
    src = scratch_path(spark, "messages")
    encode_messages(load_behavior(spark, sf_dir)).write.text(src)
    return src


def _run_stream(spark: SparkSession, src: str, table: str, mode: str,
                checkpoint: str | None = None, exact_uv: bool = False) -> None:
    query = start_realtime_stats(
        read_message_stream(spark, path=src),
        realtime_table_sink(table, skip_unchanged=(mode == "complete")),
        checkpoint or scratch_path(spark, "stream-ckpt"),
        mode=mode,
        available_now=True,
        exact_uv=exact_uv,
    )
    _finish(query)


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _time_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behavior rows with ``piece`` 0 to 3, consecutive time spans."""
    behavior = load_behavior(spark, sf_dir)
    lo, hi = behavior.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = ((hi or 0) - (lo or 0)) // 4 + 1
    piece = F.coalesce(F.floor((F.col("timestamp") - F.lit(lo or 0)) / F.lit(step)), F.lit(0)).cast("int")
    return behavior.withColumn("piece", piece)


def _stream_in_pieces(spark: SparkSession, rows: DataFrame, table: str, mode: str = "update") -> str:
    """Feed the stream the rows of ``piece`` 0, 1, ...: each piece's folder is
    moved in before the next trigger of the same query (same checkpoint), like
    traffic arriving over time. The messages are written once."""
    src, draft = scratch_path(spark, "messages"), scratch_path(spark, "message-pieces")
    checkpoint = scratch_path(spark, "stream-ckpt")
    rows.select(message_json().alias("value"), "piece").write.partitionBy("piece").text(draft)
    for piece in sorted((n for n in list_names(spark, draft) if n.startswith("piece=")), key=lambda n: int(n[6:])):
        move_path(spark, f"{draft}/{piece}", f"{src}/{piece.replace('=', '-')}")
        _run_stream(spark, f"{src}/*", table, mode, checkpoint)
    return f"{src}/*"


def _stream_result(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # uv is approximate in a stream: it is held against the exact count.
    return _ntz_windows(_uv_checked(read_serving_files(spark, table).drop("window_day"),
                                    window_stats(load_behavior(spark, sf_dir))))


def q_stream_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realtime job on a file stream: watermark, hop windows, complete mode,
    foreachBatch upsert into the serving table."""
    src = _message_files(spark, sf_dir)
    table = scratch_path(spark, "realtime-stats")
    _run_stream(spark, src, table, "complete")
    return _stream_result(spark, sf_dir, table)


def q_stream_window_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realtime job with exact uv: chained stateful aggregates in append
    mode. Returns the windows the final watermark has closed."""
    src = _message_files(spark, sf_dir)
    table = scratch_path(spark, "realtime-stats")
    _run_stream(spark, src, table, "append", exact_uv=True)
    return _ntz_windows(read_serving_files(spark, table)).select(
        "window_start", "window_end", "pv", "uv", "sales")


def q_realtime_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realtime job in update mode over four consecutive time spans, one
    per trigger (windows spanning two spans are updated by the later batch),
    then run again from scratch over the same input into the same table: the
    keyed upsert keeps one row per window with its final value."""
    table = scratch_path(spark, "realtime-stats")
    src = _stream_in_pieces(spark, _time_spans(spark, sf_dir), table)
    _run_stream(spark, src, table, "update")
    return _stream_result(spark, sf_dir, table)


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the rows (by their second) arrive after all others."""
    second = F.floor(F.col("timestamp") / F.lit(1000))
    late = F.coalesce(F.pmod(second, F.lit(7)) == 3, F.lit(False))
    return load_behavior(spark, sf_dir).withColumn("piece", late.cast("int"))


def q_stream_late_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data in update mode: rows behind the watermark no longer change a closed window."""
    table = scratch_path(spark, "realtime-stats")
    _stream_in_pieces(spark, _late_rows(spark, sf_dir), table, "update")
    return _ntz_windows(read_serving_files(spark, table)).select("window_start", "window_end", "pv", "sales")


def q_stream_late_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data in complete mode: every row counts, however late."""
    table = scratch_path(spark, "realtime-stats")
    _stream_in_pieces(spark, _late_rows(spark, sf_dir), table, "complete")
    return _stream_result(spark, sf_dir, table)


def q_stream_window_stats_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realtime job with a state row for each minute: four time spans, one per trigger; sketches of
    the changed minutes are united into windows at the sink."""
    src, draft, checkpoint = (scratch_path(spark, x) for x in ("messages", "message-pieces", "stream-ckpt"))
    panes, table = scratch_path(spark, "panes"), scratch_path(spark, "realtime-stats")
    _time_spans(spark, sf_dir).select(message_json().alias("value"), "piece").write.partitionBy("piece").text(draft)
    for piece in (n for n in list_names(spark, draft) if n.startswith("piece=")):
        move_path(spark, f"{draft}/{piece}", f"{src}/{piece.replace('=', '-')}")
        _finish(start_pane_stats(read_message_stream(spark, path=f"{src}/*"), panes, table, checkpoint, available_now=True))
    return _stream_result(spark, sf_dir, table)


#: Every so many seconds of event time a row's clock is moved far ahead.
AHEAD_EVERY = 11
_CENTURY_MS = 3_153_600_000_000


def q_stream_ahead_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose clock is far ahead, by minute, beside the minutes of all others: the stats query takes
    its input in one trigger, the side query a file at a time, and each row is in exactly one of them."""
    second = F.floor(F.col("timestamp") / F.lit(1000))
    far = F.coalesce(F.pmod(second, F.lit(AHEAD_EVERY)) == 0, F.lit(False))
    moved = F.when(far, F.col("timestamp") + F.lit(_CENTURY_MS)).otherwise(F.col("timestamp"))
    src, table, side = (scratch_path(spark, x) for x in ("messages", "realtime-stats", "side-rows"))
    encode_messages(load_behavior(spark, sf_dir).withColumn("timestamp", moved)).repartition(4).write.text(src)
    _finish(start_realtime_stats(read_message_stream(spark, path=src), realtime_table_sink(table),
                                 scratch_path(spark, "stream-ckpt"), mode="update", available_now=True,
                                 size="1 minute", slide="1 minute"))
    _finish(start_side_rows(read_message_stream(spark, path=src, max_files_per_trigger=1), side,
                            scratch_path(spark, "side-ckpt"), available_now=True))
    late = window_stats(spark.read.parquet(side).where("reason = 'ahead'").drop("event_time"), "1 minute", "1 minute")
    stats = read_serving_files(spark, table).select("window_start", "window_end", "pv", "sales", F.lit("stats").alias("place"))
    return _ntz_windows(stats.unionByName(late.select("window_start", "window_end", "pv", "sales", F.lit("side").alias("place"))))


def _with_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are cut off, no JSON, no object or hold a field of the wrong type (by their second)."""
    rows = load_behavior(spark, sf_dir)
    second = F.coalesce(F.pmod(F.floor(F.col("timestamp") / F.lit(1000)), F.lit(23)), F.lit(-1))
    user = F.coalesce("user_id", F.lit(""))
    at = F.coalesce(F.col("timestamp").cast("string"), F.lit("null"))
    text = (F.when(second == 1, F.concat(F.lit('{"user_id":"'), user))
            .when(second == 2, F.concat(F.lit("not json "), user))
            .when(second == 3, F.concat(F.lit('["'), user, F.lit('"]')))
            .when(second == 4, F.concat(F.lit('{"user_id":"'), user, F.lit('","behavior_type":"click","amount":"x","timestamp":'),
                                        at, F.lit("}")))
            .otherwise(message_json()))
    return rows.select(text.alias("value"), "timestamp")


def q_stream_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the realtime job sets aside of messages with planted garbage: reason, the message as it came, how often."""
    src, side = scratch_path(spark, "messages"), scratch_path(spark, "side-rows")
    _with_garbage(spark, sf_dir).select("value").write.text(src)
    _finish(start_side_rows(read_message_stream(spark, path=src), side, scratch_path(spark, "side-ckpt"), available_now=True))
    return spark.read.parquet(side).groupBy("reason", "message").agg(F.count("*").alias("n"))


def q_daily_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines of which nothing can be read, as the nightly job keeps them by day."""
    base, kept = scratch_path(spark, "landing"), scratch_path(spark, "job-unreadable")
    files.write_raw_landing(_with_garbage(spark, sf_dir), base, arrival=event_time("timestamp"))
    run_daily(spark, base, scratch_path(spark, "job-warehouse"), dates=None, unreadable_lines=kept)
    return spark.read.parquet(kept).groupBy("dt", "message").agg(F.count("*").alias("n"))


def q_serving_day_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of the newest day stored again with other values: the other days' folders are not read."""
    table = _stored_windows(spark, sf_dir)
    changed = read_serving_files(spark, table, newest=1).withColumn("pv", F.col("pv") + 1).withColumn("sales", F.col("sales") + 0.5)
    upsert_files(changed, table, REALTIME_KEYS, "window_day")
    return _ntz_windows(read_serving_files(spark, table).drop("window_day"))


def q_landing_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed by the streaming landing job (dt/hour of arrival) and
    scanned back with the fixed schema."""
    src = _message_files(spark, sf_dir)
    base = scratch_path(spark, "landing-stream")
    query = start_raw_landing(read_message_stream(spark, path=src), base,
                              scratch_path(spark, "landing-ckpt"), available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return files.read_raw_landing(spark, base).select(*BEHAVIOR_COLUMNS)


def q_daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily reports upserted into the serving table twice (re-run of a day)."""
    report = q_daily_report(spark, sf_dir).withColumn(
        "report_month", F.date_format("report_date", "yyyy-MM")
    )
    table = scratch_path(spark, "daily-reports")
    upsert_files(report, table, DAILY_KEYS, "report_month")
    upsert_files(report, table, DAILY_KEYS, "report_month")
    return read_serving_files(spark, table).drop("report_month")


def _nightly(spark: SparkSession, sf_dir: str, **outputs: str) -> None:
    run_daily(spark, _landed(spark, sf_dir), scratch_path(spark, "job-warehouse"), dates=None, **outputs)


def q_daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole nightly job over every landed day: landing JSON -> warehouse
    Parquet -> report -> upsert; returns the upserted report table."""
    table = scratch_path(spark, "job-reports")
    _nightly(spark, sf_dir, reports=table)
    return read_serving_files(spark, table).drop("report_month")


def q_daily_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best products as the nightly job stores them."""
    table = scratch_path(spark, "job-top-products")
    _nightly(spark, sf_dir, top_products=table)
    return read_serving_files(spark, table).drop("report_month")


def q_daily_category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by category as the nightly job stores them."""
    table = scratch_path(spark, "job-category-sales")
    _nightly(spark, sf_dir, category_sales=table)
    return read_serving_files(spark, table).drop("report_month")


QUERIES: dict[str, Query] = {
    "window_stats": q_window_stats,
    "event_time": q_event_time,
    "json_roundtrip": q_json_roundtrip,
    "daily_total_sales": q_daily_total_sales,
    "top_products": q_top_products,
    "behavior_funnel": q_behavior_funnel,
    "category_sales": q_category_sales,
    "daily_report": q_daily_report,
    "window_stats_approx": q_window_stats_approx,
    "window_stats_expand": q_window_stats_expand,
    "window_stats_sketch": q_window_stats_sketch,
    "latest_windows": q_latest_windows,
    "daily_series": q_daily_series,
    "funnel_last7": q_funnel_last7,
    "parquet_roundtrip": q_parquet_roundtrip,
    "raw_landing_scan": q_raw_landing_scan,
    "landing_day_scan": q_landing_day_scan,
    "warehouse_day_read": q_warehouse_day_read,
    "stream_window_stats": q_stream_window_stats,
    "stream_window_stats_exact": q_stream_window_stats_exact,
    "realtime_upsert": q_realtime_upsert,
    "landing_stream_scan": q_landing_stream_scan,
    "daily_upsert": q_daily_upsert,
    "daily_job": q_daily_job,
    "daily_top_products": q_daily_top_products,
    "daily_category_sales": q_daily_category_sales,
    "stream_late_update": q_stream_late_update,
    "stream_late_complete": q_stream_late_complete,
    "stream_window_stats_panes": q_stream_window_stats_panes,
    "stream_ahead_rows": q_stream_ahead_rows,
    "stream_garbage": q_stream_garbage,
    "daily_garbage": q_daily_garbage,
    "serving_day_upsert": q_serving_day_upsert,
}

ORACLE_SQL: dict[str, str] = {
    "window_stats": oracle.WINDOW_STATS,
    "event_time": oracle.EVENT_TIME,
    "json_roundtrip": oracle.JSON_ROUNDTRIP,
    "daily_total_sales": oracle.DAILY_TOTAL_SALES,
    "top_products": oracle.TOP_PRODUCTS,
    "behavior_funnel": oracle.BEHAVIOR_FUNNEL,
    "category_sales": oracle.CATEGORY_SALES,
    "daily_report": oracle.DAILY_REPORT,
    "window_stats_expand": oracle.WINDOW_STATS,
    "window_stats_approx": oracle.WINDOW_STATS_UV,
    "window_stats_sketch": oracle.WINDOW_STATS_UV,
    "latest_windows": oracle.LATEST_WINDOWS,
    "daily_series": oracle.DAILY_SERIES,
    "funnel_last7": oracle.FUNNEL_LAST7,
    "parquet_roundtrip": oracle.PARQUET_ROUNDTRIP,
    "raw_landing_scan": oracle.RAW_LANDING_SCAN,
    "stream_window_stats": oracle.WINDOW_STATS_UV,
    "stream_window_stats_exact": oracle.WINDOW_STATS_CLOSED,
    "realtime_upsert": oracle.WINDOW_STATS_UV,
    "landing_stream_scan": oracle.JSON_ROUNDTRIP,
    "daily_upsert": oracle.DAILY_REPORT,
    "daily_job": oracle.DAILY_REPORT,
    "landing_day_scan": oracle.FIRST_DAYS,
    "warehouse_day_read": oracle.FIRST_DAYS,
    "daily_top_products": oracle.TOP_PRODUCTS,
    "daily_category_sales": oracle.CATEGORY_SALES,
    "stream_late_update": oracle.WINDOW_STATS_LATE,
    "stream_late_complete": oracle.WINDOW_STATS_UV,
    "stream_window_stats_panes": oracle.WINDOW_STATS_UV,
    "stream_ahead_rows": oracle.STREAM_AHEAD_ROWS,
    "stream_garbage": oracle.STREAM_GARBAGE,
    "daily_garbage": oracle.DAILY_GARBAGE,
    "serving_day_upsert": oracle.SERVING_DAY_UPSERT,
}
