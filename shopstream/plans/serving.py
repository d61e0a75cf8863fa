"""Read-side views of the serving tables, shaped for the dashboard charts.

Each view keeps the most recent N keys and returns them oldest first. The
limit runs as a top-k (each task keeps its own N best, one task merges them),
so the final sort only ever sees N rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.timefns import window_label
from shopstream.sources.tables import partition_names, read_serving_files

# How many points the dashboard charts show.
REALTIME_POINTS = 30
DAILY_POINTS = 30
FUNNEL_POINTS = 7


def newest_rows(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The newest partitions of a serving table (named by day or month) that together hold ``n`` rows.

    Twice as many partitions are read until they do, so a poll of a dense table
    reads one or two days whatever its history.
    """
    parts = 1
    whole = read_serving_files(spark, path)
    total = len(partition_names(spark, path))
    while parts < total:
        rows = read_serving_files(spark, path, newest=parts)
        if rows.limit(n).count() >= n:
            return rows
        parts *= 2
    return whole


def latest_windows(stats: DataFrame, n: int = REALTIME_POINTS) -> DataFrame:
    """The last ``n`` windows of ``realtime_stats``, oldest first, with a label.

    Pass window bounds as TIMESTAMP_NTZ (UTC wall clock) for UTC labels; a
    TIMESTAMP is labelled in the session time zone.
    """
    last = stats.orderBy(F.col("window_start").desc()).limit(n)
    return last.select(
        "window_start",
        "window_end",
        window_label("window_start", "window_end").alias("label"),
        "pv",
        "uv",
        "sales",
    ).orderBy("window_start")


def _money_text(col: str) -> Column:
    return F.format_string("%.2f", F.coalesce(F.col(col), F.lit(0.0)))


def _product_text(i: int) -> Column:
    return F.concat(
        F.coalesce(F.col(f"top{i}_product"), F.lit("")), F.lit(" ("), _money_text(f"top{i}_sales"),
        F.lit(")"),
    )


def daily_series(reports: DataFrame, n: int = DAILY_POINTS) -> DataFrame:
    """The last ``n`` days of ``daily_reports``, oldest first, display-ready.

    Null cells read as 0 / empty instead of failing.
    """
    last = reports.orderBy(F.col("report_date").desc()).limit(n)
    return last.select(
        F.col("report_date").cast("string").alias("date"),
        F.coalesce(F.col("total_sales"), F.lit(0.0)).alias("total_sales"),
        _money_text("total_sales").alias("total_sales_text"),
        *[_product_text(i).alias(f"top{i}") for i in (1, 2, 3)],
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("click_uv", "cart_uv", "buy_uv")],
    ).orderBy("date")


def funnel_last(reports: DataFrame, n: int = FUNNEL_POINTS) -> DataFrame:
    """Users per step for the last ``n`` days, oldest first."""
    last = reports.orderBy(F.col("report_date").desc()).limit(n)
    return last.select(
        "report_date",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("click_uv", "cart_uv", "buy_uv")],
    ).orderBy("report_date")
