"""The nightly job end to end on landed files."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SAMPLE_MESSAGES
from shopstream.plans.jobs import default_dates, run_daily
from shopstream.session import scratch_path
from shopstream.sources import files
from shopstream.sources.tables import read_table


def _land(base, day, hour, lines):
    d = os.path.join(base, f"dt={day}", f"hour={hour}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"events.{len(os.listdir(d))}.log"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_daily_job_one_day_then_another(spark):
    landing = scratch_path(spark, "job-land")
    warehouse = scratch_path(spark, "job-wh")
    reports = scratch_path(spark, "job-rep")
    _land(landing, "2023-11-14", "22", SAMPLE_MESSAGES)
    # Arrived after midnight: counts on the arrival day.
    _land(landing, "2023-11-15", "00", [SAMPLE_MESSAGES[2].replace("u_1003", "u_2000")])

    out = run_daily(spark, landing, warehouse, reports, dates=["2023-11-14"])
    rep = out.report.collect()
    assert [tuple(r) for r in rep] == [
        (dt.date(2023, 11, 14), 99.9, "i_5004", 99.9, "", 0.0, "", 0.0, 2, 1, 1)]
    assert {r.item_id for r in out.top_products.collect()} == {"i_5004"}
    assert files.read_warehouse(spark, warehouse).count() == 5

    run_daily(spark, landing, warehouse, reports, dates=["2023-11-15"])
    table = {r.report_date: r for r in read_table(spark, reports).collect()}
    assert set(table) == {dt.date(2023, 11, 14), dt.date(2023, 11, 15)}
    assert table[dt.date(2023, 11, 15)].buy_uv == 1 and table[dt.date(2023, 11, 15)].click_uv == 0
    assert files.read_warehouse(spark, warehouse).count() == 6       # day 1 kept

    # Re-running day 1 changes nothing.
    run_daily(spark, landing, warehouse, reports, dates=["2023-11-14"])
    assert read_table(spark, reports).count() == 2
    assert files.read_warehouse(spark, warehouse).count() == 6


def test_missing_day_gives_no_rows(spark):
    landing = scratch_path(spark, "job-land2")
    _land(landing, "2023-11-14", "22", SAMPLE_MESSAGES)
    out = run_daily(spark, landing, scratch_path(spark, "job-wh2"), None,
                    dates=["2023-12-01"])
    assert out.report.count() == 0


def test_default_date_is_yesterday():
    (d,) = default_dates()
    assert d == (dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()


def test_default_date_in_a_zone():
    from zoneinfo import ZoneInfo

    (d,) = default_dates("Asia/Shanghai")
    assert d == (dt.datetime.now(ZoneInfo("Asia/Shanghai")).date() - dt.timedelta(days=1)).isoformat()


def test_landing_days_in_a_zone_eight_hours_ahead(spark):
    from pyspark.sql import functions as F

    base = scratch_path(spark, "zone-land")
    rows = spark.createDataFrame([(SAMPLE_MESSAGES[0], 1700000000), (SAMPLE_MESSAGES[2], 1699999200 - 7 * 3600)],
                                 "value string, at long")     # 22:13 and 15:00 UTC on 2023-11-14
    files.write_raw_landing(rows, base, arrival=F.timestamp_seconds("at"), zone="Asia/Shanghai")
    got = {(str(r.dt), r.hour) for r in files.read_raw_landing(spark, base).collect()}
    assert got == {("2023-11-15", 6), ("2023-11-14", 23)}
    out = run_daily(spark, base, scratch_path(spark, "zone-wh"), None, dates=["2023-11-15"])
    assert [(r.report_date, r.click_uv, r.buy_uv) for r in out.report.collect()] == [(dt.date(2023, 11, 15), 1, 0)]


def test_one_scan_of_the_warehouse_for_all_results(spark, monkeypatch):
    from shopstream.operators import daily
    from shopstream.plans import jobs

    landing, warehouse = scratch_path(spark, "one-land"), scratch_path(spark, "one-wh")
    _land(landing, "2023-11-14", "22", SAMPLE_MESSAGES)
    kept, leaves = {}, []

    def leaf_names(df):
        found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return [found.apply(i).nodeName() for i in range(found.size())]

    def facts(rows, day_by):
        kept["facts"] = daily.__dict__["_plain_facts"](rows, day_by)
        return kept["facts"]

    monkeypatch.setattr(daily, "_plain_facts", daily.daily_facts, raising=False)
    monkeypatch.setattr(daily, "daily_facts", facts)
    monkeypatch.setattr(jobs, "_store_days", lambda rows, path, many=False: leaves.append(leaf_names(rows)))
    run_daily(spark, landing, warehouse, "r", dates=["2023-11-14"], top_products="t", category_sales="c")
    assert len(leaf_names(kept["facts"])) == 1                                    # one scan of the warehouse
    assert len(leaves) == 3 and all(set(x) == {"InMemoryRelation"} for x in leaves)  # every result comes from the kept facts


def test_odd_input_is_counted_and_unreadable_lines_are_kept(spark, caplog):
    import logging

    landing, kept = scratch_path(spark, "odd-land"), scratch_path(spark, "odd-kept")
    lines = [*SAMPLE_MESSAGES, "garbage", "", '{"user_id":"u_9","amount":"x","timestamp":1700000000000}', "[1, 2]", "{}",
             '{"user_id":"u_1","behavior_type":"buy","amount":1e17,"timestamp":1700000000000000000}']
    _land(landing, "2023-11-14", "22", lines)
    _land(landing, "2023-11-15", "01", SAMPLE_MESSAGES[:1] + ["more garbage"])
    with caplog.at_level(logging.INFO, logger="shopstream.jobs"):
        run_daily(spark, landing, scratch_path(spark, "odd-wh"), None, dates=["2023-11-14"], unreadable_lines=kept)
    assert "'unreadable': 3" in caplog.text and "'odd_times': 1" in caplog.text and "'odd_amounts': 1" in caplog.text
    got = lambda: sorted((str(r.dt), r.message) for r in spark.read.parquet(kept).collect())
    assert got() == [("2023-11-14", "[1, 2]"), ("2023-11-14", "garbage"), ("2023-11-14", "{}")]
    run_daily(spark, landing, scratch_path(spark, "odd-wh"), None, dates=["2023-11-15"], unreadable_lines=kept)
    assert len(got()) == 4                                                          # other days stay
    os.remove(next(e.path for e in os.scandir(os.path.join(landing, "dt=2023-11-14", "hour=22"))))
    _land(landing, "2023-11-14", "22", SAMPLE_MESSAGES)
    run_daily(spark, landing, scratch_path(spark, "odd-wh"), None, dates=["2023-11-14"], unreadable_lines=kept)
    assert got() == [("2023-11-15", "more garbage")]                                # a repaired day has none any more


def test_stored_products_and_categories(spark):
    landing, warehouse = scratch_path(spark, "st-land"), scratch_path(spark, "st-wh")
    tops, cats = scratch_path(spark, "st-top"), scratch_path(spark, "st-cat")
    _land(landing, "2023-11-14", "22", SAMPLE_MESSAGES)
    for _ in range(2):                                   # a re-run replaces the day
        run_daily(spark, landing, warehouse, dates=["2023-11-14"], top_products=tops, category_sales=cats)
    assert [(r["rank"], r.item_id) for r in read_table(spark, tops).collect()] == [(1, "i_5004")]
    assert [r.category_id for r in read_table(spark, cats).collect()] == ["c_303"]


def test_command_line_options():
    import pytest

    from shopstream.plans.jobs import _parser

    ap = _parser()
    a = ap.parse_args(["realtime", "--path", "p", "--checkpoint", "c", "--jdbc-url", "u", "--jdbc-option", "user=x",
                       "--kafka-option", "maxOffsetsPerTrigger=5", "--timezone", "Asia/Shanghai"])
    assert a.jdbc_option == ["user=x"] and a.kafka_option == ["maxOffsetsPerTrigger=5"]
    assert ap.parse_args(["landing", "--path", "p", "--landing", "l", "--checkpoint", "c"]).landing == "l"
    with pytest.raises(SystemExit):
        ap.parse_args(["realtime", "--path", "p", "--table", "t"])       # no checkpoint


def test_realtime_job_keeps_rows_far_ahead_by_default():
    from shopstream.plans.jobs import _parser, ahead_rows_folder

    base = ["realtime", "--path", "p", "--table", "t", "--checkpoint", "/c/q/"]
    folder = lambda *more: ahead_rows_folder(_parser().parse_args([*base, *more]))
    assert folder() == "/c/q-ahead-rows" and folder("--ahead-rows", "/x") == "/x"
    assert folder("--no-ahead-rows") is None


def test_realtime_job_starts_the_side_table(spark, monkeypatch):
    from shopstream.plans import jobs
    from shopstream.streaming import monitor, realtime

    started = {}
    monkeypatch.setattr(realtime, "read_message_stream", lambda *a, **k: "messages")
    monkeypatch.setattr(realtime, "start_realtime_stats", lambda *a, **k: started.setdefault("stats", a[2]))
    monkeypatch.setattr(realtime, "start_side_rows", lambda m, path, ckpt, **k: started.setdefault("ahead", (path, ckpt)))
    monkeypatch.setattr(type(spark.streams), "awaitAnyTermination", lambda self, *a: None)
    monkeypatch.setattr(type(spark.streams), "addListener", lambda self, x: None)
    jobs._main(["realtime", "--path", "p", "--table", "t", "--checkpoint", "/c/q"])
    assert started == {"stats": "/c/q", "ahead": ("/c/q-ahead-rows", "/c/q-ahead")}
    started.clear()
    jobs._main(["realtime", "--path", "p", "--table", "t", "--checkpoint", "/c/q", "--no-ahead-rows"])
    assert started == {"stats": "/c/q"}
