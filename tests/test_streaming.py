"""Structured Streaming: stream == batch, late data per output mode."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from shopstream.functions.jsonfns import encode_messages
from shopstream.functions.timefns import utc_wall_clock
from shopstream.operators.windows import window_stats
from shopstream.session import scratch_path
from shopstream.sources.events import load_behavior
from shopstream.sources.tables import read_table
from shopstream.streaming.realtime import (
    read_message_stream,
    realtime_table_sink,
    start_raw_landing,
    start_realtime_stats,
)

BASE = dt.datetime(2023, 11, 14, 22, 0)


def _windows(spark, table):
    df = read_table(spark, table)
    return sorted(
        (r[0], r[1], r[2], r[3])
        for r in df.select(utc_wall_clock("window_start"), utc_wall_clock("window_end"),
                           "pv", "sales").collect()
    )


def test_stream_equals_batch(spark):
    b = load_behavior(spark, SMOKE_DIR)
    src = scratch_path(spark, "t-msgs")
    encode_messages(b).repartition(4).write.text(src)
    table = scratch_path(spark, "t-table")
    q = start_realtime_stats(read_message_stream(spark, path=src, max_files_per_trigger=2),
                             realtime_table_sink(table), scratch_path(spark, "t-ckpt"),
                             mode="complete", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    batch = window_stats(b, exact_uv=False)
    want = sorted(
        (r[0], r[1], r[2], r[3])
        for r in batch.select(utc_wall_clock("window_start"), utc_wall_clock("window_end"),
                              "pv", "sales").collect()
    )
    assert _windows(spark, table) == want


def _msg(minute, kind, amount=0.0, user="u_1"):
    ms = int(dt.datetime(2023, 11, 14, 22, 0, tzinfo=dt.timezone.utc).timestamp() * 1000) + minute * 60_000
    return json.dumps({"user_id": user, "item_id": "i_1", "category_id": "c_1",
                       "behavior_type": kind, "quantity": 0, "amount": amount, "timestamp": ms})


LATE_FILES = [
    [_msg(0, "click"), _msg(120, "buy", 9.5)],
    [_msg(121, "click")],
    [_msg(1, "click"), _msg(100, "buy", 1.0)],
    [_msg(300, "click")],
]


def _run_late(spark, mode):
    src = scratch_path(spark, "late-src")
    os.makedirs(src)
    table = scratch_path(spark, "late-table")
    ckpt = scratch_path(spark, "late-ckpt")
    for i, lines in enumerate(LATE_FILES):
        with open(os.path.join(src, f"f{i}.json"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        q = start_realtime_stats(read_message_stream(spark, path=src),
                                 realtime_table_sink(table, skip_unchanged=(mode == "complete")),
                                 ckpt, mode=mode, available_now=True, size="5 minutes",
                                 slide="5 minutes")
        q.awaitTermination()
        assert q.exception() is None
    return {r[0]: (r[2], r[3]) for r in _windows(spark, table)}


def test_late_data_complete_mode_keeps_everything(spark):
    got = _run_late(spark, "complete")
    assert got[BASE] == (2, 0.0)                              # late click counted
    assert got[BASE + dt.timedelta(minutes=100)] == (0, 1.0)
    assert got[BASE + dt.timedelta(minutes=120)] == (1, 9.5)
    assert got[BASE + dt.timedelta(minutes=300)] == (1, 0.0)


def test_late_data_update_mode_drops_late_rows(spark):
    got = _run_late(spark, "update")
    assert got[BASE] == (1, 0.0)                              # late click dropped
    assert got[BASE + dt.timedelta(minutes=100)] == (0, 1.0)  # after the 23:31 watermark
    assert got[BASE + dt.timedelta(minutes=120)] == (1, 9.5)
    assert got[BASE + dt.timedelta(minutes=300)] == (1, 0.0)


def test_raw_landing_stream(spark):
    src = scratch_path(spark, "land-src")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join(l for f in LATE_FILES for l in f) + "\n")
    base = scratch_path(spark, "land-out")
    q = start_raw_landing(read_message_stream(spark, path=src), base,
                          scratch_path(spark, "land-ckpt"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    from shopstream.sources.files import read_raw_landing
    df = read_raw_landing(spark, base)
    assert df.count() == 6
    today = df.select(F.max("dt")).first()[0]
    assert read_raw_landing(spark, base, dates=[str(today)]).count() == 6
    assert read_raw_landing(spark, base, dates=["1999-01-01"]).count() == 0


def test_complete_mode_rewrites_only_changed_days(spark):
    src = scratch_path(spark, "cm-src")
    os.makedirs(src)
    table = scratch_path(spark, "cm-table")
    ckpt = scratch_path(spark, "cm-ckpt")

    def run(name, lines):
        with open(os.path.join(src, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        q = start_realtime_stats(read_message_stream(spark, path=src),
                                 realtime_table_sink(table, skip_unchanged=True),
                                 ckpt, mode="complete", available_now=True)
        q.awaitTermination()
        assert q.exception() is None

    run("a.json", [_msg(0, "click"), _msg(24 * 60 + 5, "click")])      # two days
    day1 = lambda: [f for f in read_table(spark, table).inputFiles() if "window_day=2023-11-14" in f]
    before = day1()
    run("b.json", [_msg(24 * 60 + 6, "buy", 2.0)])                        # day two only
    assert day1() == before
    got = {r[0]: (r[2], r[3]) for r in _windows(spark, table)}
    assert got[BASE + dt.timedelta(minutes=24 * 60 + 5)] == (1, 2.0)
    assert got[BASE] == (1, 0.0)


def test_exact_uv_stream_equals_batch_on_closed_windows(spark):
    # Three consecutive time spans arrive one after another (in event-time
    # order, so nothing is late); each is processed by the next trigger.
    b = load_behavior(spark, SMOKE_DIR)
    src = scratch_path(spark, "ex-msgs")
    table = scratch_path(spark, "ex-table")
    ckpt = scratch_path(spark, "ex-ckpt")
    lo, hi = b.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (hi - lo) // 3 + 1
    for i in range(3):
        piece = b.where((F.col("timestamp") >= lo + i * step) & (F.col("timestamp") < lo + (i + 1) * step))
        encode_messages(piece).write.mode("append").text(src)
        q = start_realtime_stats(read_message_stream(spark, path=src), realtime_table_sink(table),
                                 ckpt, mode="append", available_now=True, exact_uv=True)
        q.awaitTermination()
        assert q.exception() is None
    got = {r[0]: tuple(r[1:]) for r in read_table(spark, table).select(
        utc_wall_clock("window_start"), "pv", "uv", "sales").collect()}
    want = {r[0]: tuple(r[1:]) for r in window_stats(b).select(
        utc_wall_clock("window_start"), "pv", "uv", "sales").collect()}
    assert got and set(got) <= set(want)
    assert all(got[k] == want[k] for k in got)          # exact, final values


def test_exact_uv_needs_append_mode(spark):
    src = scratch_path(spark, "ex2")
    os.makedirs(src)
    with pytest.raises(ValueError):
        start_realtime_stats(read_message_stream(spark, path=src), lambda df, i: None,
                             scratch_path(spark, "ex2-ckpt"), mode="update", exact_uv=True)


def test_exact_uv_append_mode_with_late_data(spark):
    src = scratch_path(spark, "ex-late-src")
    os.makedirs(src)
    table = scratch_path(spark, "ex-late-table")
    ckpt = scratch_path(spark, "ex-late-ckpt")
    for i, lines in enumerate(LATE_FILES):
        with open(os.path.join(src, f"f{i}.json"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        q = start_realtime_stats(read_message_stream(spark, path=src), realtime_table_sink(table),
                                 ckpt, mode="append", available_now=True, exact_uv=True,
                                 size="5 minutes", slide="5 minutes")
        q.awaitTermination()
        assert q.exception() is None
    df = read_table(spark, table)
    got = {r[0]: tuple(r[1:]) for r in df.select(
        utc_wall_clock("window_start"), "pv", "uv", "sales").collect()}
    # Final watermark: latest event (minute 300) - 30 min = minute 270. Windows
    # ending by then are emitted once; the late click at minute 1 was behind
    # the watermark and is dropped; the window at minute 300 is still open.
    assert got == {
        BASE: (1, 1, 0.0),
        BASE + dt.timedelta(minutes=100): (0, 1, 1.0),
        BASE + dt.timedelta(minutes=120): (1, 1, 9.5),
    }


def _run_files(spark, name, files, mode="update", **options):
    """A trigger for each list of message lines."""
    src, table, ckpt = (scratch_path(spark, f"{name}-{x}") for x in ("src", "table", "ckpt"))
    os.makedirs(src)
    for i, lines in enumerate(files):
        with open(os.path.join(src, f"f{i}.json"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        q = start_realtime_stats(read_message_stream(spark, path=src), realtime_table_sink(table), ckpt, mode=mode,
                                 available_now=True, size="5 minutes", slide="5 minutes", **options)
        q.awaitTermination()
        assert q.exception() is None
    return src, table, q


def test_one_wrong_clock_closes_nobodys_windows(spark):
    from shopstream.streaming.realtime import start_side_rows

    wrong = _msg(40_000_000, "click")                     # some 76 years ahead
    src, table, q = _run_files(spark, "clock", [[_msg(0, "click"), wrong], [_msg(10, "click")], [_msg(20, "buy", 3.0)]])
    got = {r[0]: (r[2], r[3]) for r in _windows(spark, table)}
    assert got == {BASE: (1, 0.0), BASE + dt.timedelta(minutes=10): (1, 0.0), BASE + dt.timedelta(minutes=20): (0, 3.0)}
    side = scratch_path(spark, "clock-side")
    a = start_side_rows(read_message_stream(spark, path=src), side, scratch_path(spark, "clock-side-ckpt"), available_now=True)
    a.awaitTermination()
    assert [r.behavior_type for r in spark.read.parquet(side).collect()] == ["click"]


POISON = ['{"user_id":"u_1","behavior_type":"buy","amount":5.0,"timestamp":1700000000000000000}',
          '{"user_id":"u_1","behavior_type":"buy","amount":1e17,"timestamp":1700000000000}',
          '{"user_id":"u_1","behavior_type":"buy","amount":"NaN","timestamp":1700000000000}']


def test_no_message_stops_the_stream_or_the_batch(spark):
    from pyspark.sql import types as T

    from shopstream.functions.jsonfns import decode_messages
    from shopstream.operators import daily
    from conftest import messages_df

    good = [_msg(13, "buy", 1.005), _msg(13, "buy", 1.005), _msg(13, "buy", 1.005), _msg(13, "click")]
    src, table, q = _run_files(spark, "poison", [good + POISON, [_msg(14, "click")]])
    got = {r[0]: (r[2], r[3]) for r in _windows(spark, table)}
    assert got == {BASE + dt.timedelta(minutes=10): (2, 3.015)}
    checks = [p.observedMetrics["input_checks"] for p in q.recentProgress if p.observedMetrics]
    assert checks is not None
    rows = decode_messages(messages_df(spark, good + POISON))
    batch = window_stats(rows, "5 minutes", "5 minutes").collect()
    assert [(r.pv, r.sales) for r in batch] == [(1, 3.015)]
    (report,) = daily.daily_report(rows).collect()
    assert report.total_sales == 3.015
    assert isinstance(rows.schema["amount"].dataType, T.DoubleType)


def test_odd_values_are_counted(spark):
    from shopstream.functions.jsonfns import decode_messages
    from shopstream.functions.money import odd_amount
    from shopstream.functions.timefns import odd_time
    from conftest import messages_df

    rows = decode_messages(messages_df(spark, POISON + [_msg(0, "buy", 2.0)]))
    r = rows.agg(F.count_if(odd_time()).alias("t"), F.count_if(odd_amount("amount")).alias("a")).first()
    assert (r.t, r.a) == (1, 2)                          # the decoder reads "NaN" as the number NaN


def test_a_replayed_landing_batch_lands_once(spark):
    from shopstream.sources.files import read_raw_landing, write_raw_landing
    from shopstream.streaming.realtime import landing_sink

    base = scratch_path(spark, "land-replay")
    sink = landing_sink(base)
    rows = spark.createDataFrame([(_msg(i, "click"),) for i in range(20)], "value string") \
        .withColumn("arrival", F.lit("2024-01-05 10:00:00").cast("timestamp"))
    sink(rows, 3)
    sink(rows.repartition(5), 3)                          # the same batch again, in other tasks
    sink(rows.limit(2), 4)
    write_raw_landing(rows.select("value").limit(1), base, arrival=F.lit("2024-01-05 10:00:00").cast("timestamp"))
    assert read_raw_landing(spark, base, dates=["2024-01-05"]).count() == 23


def test_estimate_over_a_whole_day(spark):
    """The estimator's bound where windows hold many users."""
    rows = spark.range(40_000).selectExpr("concat('u_', id % 9000) AS user_id", "'click' AS behavior_type", "0.0D AS amount",
                                          "1704067200000 + (id * 2000) AS timestamp")
    for strategy in ("expand", "panes"):
        for r in window_stats(rows, "24 hours", "24 hours", exact_uv=False, strategy=strategy).collect():
            assert abs(r.uv - 9000) <= 0.2 * 9000


def test_progress_is_logged_with_every_state_operator(spark, caplog):
    import logging
    import time

    from shopstream.streaming.monitor import ProgressLogger

    listener = ProgressLogger()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="shopstream.streaming"):
            _run_files(spark, "logged", [LATE_FILES[0] + POISON[:1]], mode="append", exact_uv=True)
            for _ in range(50):
                if any("input rows" in r.getMessage() for r in caplog.records):
                    break
                time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    lines = [r.getMessage() for r in caplog.records if "input rows" in r.getMessage()]
    assert lines and "3 input rows" in lines[0]
    assert lines[0].count("(") >= 3                       # both stateful steps of the chain
    assert "'odd_times': 1" in lines[0]
