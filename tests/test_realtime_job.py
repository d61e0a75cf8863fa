"""Side rows, panes, state stores and file sources of the realtime and landing jobs."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from shopstream.functions.jsonfns import encode_messages
from shopstream.functions.timefns import utc_wall_clock
from shopstream.operators.windows import window_stats
from shopstream.plans.registry import _uv_checked
from shopstream.session import scratch_path
from shopstream.sources.events import load_behavior
from shopstream.sources.files import read_raw_landing
from shopstream.sources.tables import read_table
from shopstream.streaming import realtime as rt

BASE = dt.datetime(2023, 11, 14, 22, 0, tzinfo=dt.timezone.utc)


def _msg(at: dt.datetime, kind="click", amount=0.0, user="u_1"):
    return json.dumps({"user_id": user, "item_id": "i_1", "category_id": "c_1", "behavior_type": kind, "quantity": 0,
                       "amount": amount, "timestamp": int(at.timestamp() * 1000)})


def _write(folder, name, lines, written: dt.datetime | None = None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    if written is not None:
        os.utime(path, (written.timestamp(), written.timestamp()))


def _done(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


# ---------------------------------------------------------------- arrival and side rows

def test_each_row_is_in_exactly_one_place_at_any_trigger(spark):
    """Files written at known times; the two queries run at other times and in other batches."""
    src, table, side, ck1, ck2 = (scratch_path(spark, f"split-{x}") for x in ("src", "table", "side", "ck1", "ck2"))
    minute = dt.timedelta(minutes=1)
    rows = []
    for i in range(6):
        written = BASE + 20 * i * minute
        for k in range(-30, 150, 7):                       # some are more than an hour after the file's time
            rows.append((written + k * minute, k > 60))
        _write(src, f"f{i}.json", [_msg(t) for t, _ in rows[-26:]], written)
        if i == 2:                                          # the side query sees the first files before the others exist
            _done(rt.start_side_rows(rt.read_message_stream(spark, path=src, max_files_per_trigger=1), side, ck2, available_now=True))
    stats = rt.start_realtime_stats(rt.read_message_stream(spark, path=src), rt.realtime_table_sink(table), ck1, mode="complete",
                                    available_now=True, size="1 minute", slide="1 minute")
    _done(stats)
    time.sleep(1.1)
    _done(rt.start_side_rows(rt.read_message_stream(spark, path=src, max_files_per_trigger=2), side, ck2, available_now=True))
    kept = spark.read.parquet(side)
    assert {r.reason for r in kept.select("reason").distinct().collect()} == {"ahead"}
    counted = read_table(spark, table).agg(F.sum("pv")).first()[0]
    assert counted == sum(not far for _, far in rows) and kept.count() == sum(far for _, far in rows)
    assert counted + kept.count() == len(rows)


def test_arrival_of_a_file_is_when_it_was_written(spark):
    src, base = scratch_path(spark, "arr-src"), scratch_path(spark, "arr-land")
    _write(src, "a.json", [_msg(BASE)], BASE + dt.timedelta(hours=3))
    _done(rt.start_raw_landing(rt.read_message_stream(spark, path=src), base, scratch_path(spark, "arr-ck"), available_now=True))
    assert [(str(r.dt), r.hour) for r in read_raw_landing(spark, base).collect()] == [("2023-11-15", 1)]


def test_unreadable_and_damaged_messages_are_counted_and_kept(spark):
    src, table, side = (scratch_path(spark, f"bad-{x}") for x in ("src", "table", "side"))
    bad = ["no json", "[1, 2]", "{}", '{"user_id":"u_1"', "17"]
    damaged = '{"user_id":"u_2","behavior_type":"click","amount":"x","timestamp":%d}' % int(BASE.timestamp() * 1000)
    _write(src, "a.json", [_msg(BASE), *bad, damaged])
    q = rt.start_realtime_stats(rt.read_message_stream(spark, path=src), rt.realtime_table_sink(table),
                                scratch_path(spark, "bad-ck"), available_now=True, size="1 minute", slide="1 minute")
    _done(q)
    checks = [p.observedMetrics["input_checks"].asDict() for p in q.recentProgress if "input_checks" in p.observedMetrics]
    assert {k: sum(c[k] for c in checks) for k in ("unreadable", "damaged")} == {"unreadable": len(bad), "damaged": 1}
    assert [(r.pv, r.uv) for r in read_table(spark, table).collect()] == [(2, 2)]  # a damaged message counts with what it has
    _done(rt.start_side_rows(rt.read_message_stream(spark, path=src), side, scratch_path(spark, "bad-side-ck"), available_now=True))
    assert sorted((r.reason, r.message) for r in spark.read.parquet(side).collect()) == \
        sorted([("unreadable", b) for b in bad] + [("damaged", damaged)])


# ---------------------------------------------------------------- panes

def _rows(df):
    return {r[0]: tuple(r[1:]) for r in df.select(utc_wall_clock("window_start"), "pv", "uv", "sales").collect()}


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_panes_equal_windows_with_a_fifth_of_the_state(spark, mode):
    b = load_behavior(spark, SMOKE_DIR)
    src = scratch_path(spark, "pane-src")
    panes, table, ck, wide, wide_ck = (scratch_path(spark, f"pane-{x}") for x in ("panes", "table", "ck", "wide", "wide-ck"))
    lo, hi = b.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (hi - lo) // 3 + 1
    for i in range(3):
        encode_messages(b.where((F.col("timestamp") >= lo + i * step) & (F.col("timestamp") < lo + (i + 1) * step))) \
            .write.mode("append").text(src)
        _done(rt.start_pane_stats(rt.read_message_stream(spark, path=src), panes, table, ck, mode=mode, available_now=True))
    got, want = _rows(read_table(spark, table)), _rows(window_stats(b))
    assert got.keys() == want.keys()
    assert all((got[k][0], got[k][2]) == (want[k][0], want[k][2]) and abs(got[k][1] - want[k][1]) <= 1 for k in want)
    if mode == "complete":  # both from the start in one trigger: the store's count takes rows of a restart again
        small = _done(rt.start_pane_stats(rt.read_message_stream(spark, path=src), *(scratch_path(spark, f"one-{x}") for x in "ptc"),
                                          mode=mode, available_now=True))
        big = _done(rt.start_realtime_stats(rt.read_message_stream(spark, path=src), rt.realtime_table_sink(wide), wide_ck,
                                            mode=mode, available_now=True))
        state = [q.recentProgress[-1].stateOperators[0].numRowsTotal for q in (small, big)]
        minutes = b.select(F.floor(F.col("timestamp") / 60_000)).distinct().count()
        assert state == [minutes, len(want)] and state[0] < 0.3 * state[1]


def test_a_pane_batch_applied_again_changes_nothing(spark):
    panes, table = scratch_path(spark, "again-panes"), scratch_path(spark, "again-table")
    sink = rt.pane_sink(panes, table)
    rows = [(BASE + dt.timedelta(minutes=m), f"u_{m % 3}") for m in (0, 1, 4, 130)]
    batch = spark.createDataFrame(rows, "pane_start timestamp, user string").groupBy("pane_start").agg(
        F.count("*").alias("pv"), F.lit(1.5).cast("decimal(22,6)").alias("sales"), F.hll_sketch_agg("user").alias("users"))
    sink(batch, 0)
    first = _rows(read_table(spark, table))
    sink(batch, 0)
    assert _rows(read_table(spark, table)) == first and len(first) == 14
    assert max(v[0] for v in first.values()) == 3 and max(v[1] for v in first.values()) == 2
    sink(batch.where("pv < 0"), 1)                                   # an empty batch
    assert _rows(read_table(spark, table)) == first


def test_panes_refuse_sizes_that_are_no_multiple(spark):
    src = scratch_path(spark, "odd-src")
    os.makedirs(src)
    with pytest.raises(ValueError, match="multiple"):
        rt.start_pane_stats(rt.read_message_stream(spark, path=src), "p", "t", "c", size="5 minutes", slide="2 minutes")


# ---------------------------------------------------------------- the check of approximate uv

def test_the_uv_check_tells_a_wrong_estimator(spark):
    exact = spark.range(400).selectExpr("timestamp_seconds(id * 60) AS window_start", "timestamp_seconds(id * 60 + 300) AS window_end",
                                        "id AS pv", "1 + id % 4 AS uv", "0.5D AS sales")
    def verdict(uv):
        got = _uv_checked(exact.withColumn("uv", uv.cast("long")), exact).collect()
        want = {r.window_start: r.uv for r in exact.collect()}
        return sum(r.uv != want[r.window_start] for r in got), {r.uv_unbiased for r in got}
    assert verdict(F.col("uv")) == (0, {True})
    assert verdict(F.col("uv") + F.when(F.col("pv") % 50 == 0, 1).otherwise(0)) == (0, {True})   # off by one, rarely
    assert verdict(F.lit(2)) == (100, {False})                                                   # a constant
    assert verdict(F.col("uv") + 1) == (0, {False})                                              # always off by one
    assert verdict(F.col("uv") + 2)[0] == 400


# ---------------------------------------------------------------- state store and restarts

def _stored_providers(checkpoint):
    found = set()
    for name in os.listdir(f"{checkpoint}/offsets"):
        if name.isdigit():
            lines = open(f"{checkpoint}/offsets/{name}").read().splitlines()
            found.add(json.loads(lines[1])["conf"]["spark.sql.streaming.stateStore.providerClass"].rsplit(".", 1)[1])
    return found


def test_complete_mode_keeps_its_state_in_rocksdb_over_restarts(spark):
    files = [[_msg(BASE + dt.timedelta(minutes=m), kind, 2.0, f"u_{m}") for m in range(i * 30, i * 30 + 30)]
             for i, kind in enumerate(["click", "buy", "click", "buy"])]
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    results = []
    for name, restarts in (("once", False), ("restarted", True)):
        src, table, ck = (scratch_path(spark, f"rocks-{name}-{x}") for x in ("src", "table", "ck"))
        for i, lines in enumerate(files):
            _write(src, f"f{i}.json", lines)
            if restarts or i == len(files) - 1:
                _done(rt.start_realtime_stats(rt.read_message_stream(spark, path=src, max_files_per_trigger=1),
                                              rt.realtime_table_sink(table, skip_unchanged=True), ck, mode="complete", available_now=True))
        assert _stored_providers(ck.removeprefix("file://")) == {"RocksDBStateStoreProvider"}
        results.append(_rows(read_table(spark, table)))
    assert results[0] == results[1] and len(results[0]) == 124
    assert spark.conf.get(key) == before                             # the session keeps its own


def test_update_mode_keeps_the_sessions_store(spark):
    src, ck = scratch_path(spark, "mem-src"), scratch_path(spark, "mem-ck")
    _write(src, "a.json", [_msg(BASE)])
    _done(rt.start_realtime_stats(rt.read_message_stream(spark, path=src), rt.realtime_table_sink(scratch_path(spark, "mem-table")),
                                  ck, available_now=True))
    assert _stored_providers(ck.removeprefix("file://")) == {"HDFSBackedStateStoreProvider"}


# ---------------------------------------------------------------- file sources

def test_landed_files_are_archived_and_not_read_again(spark):
    src, archive, base, ck = (scratch_path(spark, f"arch-{x}") for x in ("src", "old", "land", "ck"))
    land = lambda: _done(rt.start_raw_landing(rt.read_message_stream(
        spark, path=src, max_files_per_trigger=1, archive=archive), base, ck, available_now=True))
    for i in range(4):
        _write(src, f"f{i}.json", [_msg(BASE + dt.timedelta(minutes=i))])
    land()
    _write(src, "g.json", [_msg(BASE + dt.timedelta(minutes=9))])
    land()                                                           # a restart goes on where it stopped
    assert read_raw_landing(spark, base).count() == 5
    for _ in range(50):
        moved = [f for _, _, names in os.walk(archive.removeprefix("file://")) for f in names if f.endswith(".json")]
        if len(moved) >= 3:
            break
        time.sleep(0.2)
    assert len(moved) >= 3 and not set(moved) & set(os.listdir(src.removeprefix("file://")))


def test_files_older_than_the_bound_are_left_out(spark):
    src, base = scratch_path(spark, "age-src"), scratch_path(spark, "age-land")
    now = dt.datetime.now(dt.timezone.utc)
    _write(src, "new.json", [_msg(BASE)], now)
    ck = scratch_path(spark, "age-ck")
    land = lambda: _done(rt.start_raw_landing(rt.read_message_stream(spark, path=src, max_file_age="1d"), base, ck,
                                              available_now=True))
    land()
    _write(src, "old.json", [_msg(BASE)], now - dt.timedelta(days=3))
    _write(src, "late.json", [_msg(BASE)], now - dt.timedelta(hours=2))
    land()
    assert read_raw_landing(spark, base).count() == 2
