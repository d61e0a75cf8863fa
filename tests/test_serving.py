"""Dashboard views: newest N, oldest first, labels, null-safe formatting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from shopstream.plans import serving
from shopstream.schema import DAILY_REPORTS


def test_latest_windows_order_and_label(spark):
    base = dt.datetime(2024, 1, 1, 23, 50)
    rows = [(base + dt.timedelta(minutes=i), base + dt.timedelta(minutes=i + 5), i, i, float(i))
            for i in range(40)]
    df = spark.createDataFrame(
        rows, "window_start timestamp_ntz, window_end timestamp_ntz, pv long, uv long, sales double")
    out = serving.latest_windows(df, n=30).collect()
    assert len(out) == 30
    assert [r.pv for r in out] == list(range(10, 40))
    assert out[0].label == "00:00-00:05" and out[-1].label == "00:29-00:34"


def test_daily_series_null_safe_and_formatted(spark):
    rows = [
        (dt.date(2024, 1, d), 10.5 * d, "i_1", 3.0, "", 0.0, None, None, 1, 2, 3) for d in range(1, 9)
    ]
    rows.append((dt.date(2024, 1, 9), None, None, None, None, None, None, None, None, None, None))
    df = spark.createDataFrame(rows, DAILY_REPORTS)
    out = serving.daily_series(df, n=30).collect()
    assert [r.date for r in out][:2] == ["2024-01-01", "2024-01-02"] and len(out) == 9
    assert out[0].total_sales_text == "10.50" and out[0].top1 == "i_1 (3.00)" and out[0].top2 == " (0.00)"
    last = out[-1]
    assert last.total_sales == 0.0 and last.top1 == " (0.00)" and last.click_uv == 0
    f7 = serving.funnel_last(df).collect()
    assert [r.report_date.day for r in f7] == [3, 4, 5, 6, 7, 8, 9]
