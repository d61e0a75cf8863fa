"""Keyed upserts, warehouse backfill, landing scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SAMPLE_MESSAGES, messages_df
from shopstream.functions.jsonfns import decode_messages
from shopstream.schema import DAILY_KEYS, REALTIME_KEYS
from shopstream.session import scratch_path
from shopstream.sources import files
from shopstream.sources import tables
from shopstream.sources.tables import merge_statement, read_table, upsert_files


def _stats(spark, rows):
    return spark.createDataFrame(
        rows, "window_start timestamp, window_end timestamp, pv long, uv long, sales double"
    ).withColumn("window_day", F.to_date("window_start"))


def test_upsert_idempotent_and_last_value_wins(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    t1 = dt.datetime(2024, 1, 2, 10, 0)
    five = dt.timedelta(minutes=5)
    path = scratch_path(spark, "t-upsert")
    first = _stats(spark, [(t0, t0 + five, 1, 1, 1.0), (t1, t1 + five, 2, 2, 2.0)])
    upsert_files(first, path, REALTIME_KEYS, "window_day")
    upsert_files(first, path, REALTIME_KEYS, "window_day")
    assert read_table(spark, path).count() == 2
    changed = _stats(spark, [(t0, t0 + five, 7, 7, 7.0), (t0 + five, t0 + 2 * five, 3, 3, 3.0)])
    upsert_files(changed, path, REALTIME_KEYS, "window_day")
    got = {r.window_start: r.pv for r in read_table(spark, path).collect()}
    assert got == {t0: 7, t0 + five: 3, t1: 2}


def test_daily_upsert_keeps_other_days(spark):
    path = scratch_path(spark, "t-daily")
    schema = "report_date date, total_sales double, report_month string"
    upsert_files(spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, "2024-01"),
                                        (dt.date(2024, 2, 1), 2.0, "2024-02")], schema),
                 path, DAILY_KEYS, "report_month")
    upsert_files(spark.createDataFrame([(dt.date(2024, 1, 1), 5.0, "2024-01")], schema),
                 path, DAILY_KEYS, "report_month")
    got = {r.report_date: r.total_sales for r in read_table(spark, path).collect()}
    assert got == {dt.date(2024, 1, 1): 5.0, dt.date(2024, 2, 1): 2.0}


def test_warehouse_backfill_leaves_other_days(spark):
    b = decode_messages(messages_df(spark, SAMPLE_MESSAGES))
    base = scratch_path(spark, "t-wh")
    files.write_warehouse(b.withColumn("dt", F.lit("2023-11-14")), base)
    files.write_warehouse(b.limit(2).withColumn("dt", F.lit("2023-11-15")), base)
    files.write_warehouse(b.limit(1).withColumn("dt", F.lit("2023-11-15")), base)
    counts = {str(r.dt): r["count"] for r in files.read_warehouse(spark, base).groupBy("dt").count().collect()}
    assert counts == {"2023-11-14": 5, "2023-11-15": 1}
    day = files.read_warehouse(spark, base, dates=["2023-11-14"])
    assert day.count() == 5 and "dt" in day.columns
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "dt" in plan
    assert files.read_warehouse(spark, base, dates=["2030-01-01"]).count() == 0


def test_landing_scan_permissive_and_blank_lines(spark):
    import os

    base = scratch_path(spark, "t-land")
    d = os.path.join(base, "dt=2023-11-14", "hour=22")
    os.makedirs(d)
    with open(os.path.join(d, "events.1.log"), "w") as fh:
        fh.write(SAMPLE_MESSAGES[0] + "\n\ngarbage\n" + '{"user_id":"u_9","amount":"x"}\n')
    with open(os.path.join(d, "ignored.tmp"), "w") as fh:
        fh.write(SAMPLE_MESSAGES[1] + "\n")
    df = files.read_raw_landing(spark, base, suffix="*.log")
    out = df.orderBy("user_id").collect()
    assert len(out) == 3                          # blank line skipped, .tmp not matched
    assert out[0].user_id is None                 # garbage -> all null
    assert out[2].user_id == "u_9" and out[2].amount is None
    assert out[1].hour == 22 and str(out[1].dt) == "2023-11-14"


def test_merge_statement_text():
    sql = merge_statement("daily_reports", "daily_reports_stage",
                          ["report_date", "total_sales"], ["report_date"])
    assert sql.startswith('MERGE INTO daily_reports t USING daily_reports_stage s ON t."report_date" = s."report_date"')
    assert 'UPDATE SET "total_sales" = s."total_sales"' in sql
    assert 'INSERT ("report_date", "total_sales") VALUES (s."report_date", s."total_sales")' in sql
    mysql = merge_statement("t", "s", ["a", "b"], ["a"], dialect="mysql")
    assert mysql == "REPLACE INTO t (`a`, `b`) SELECT `a`, `b` FROM s"


def _three_windows(spark, name):
    t0, t1, five = dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 2, 10, 0), dt.timedelta(minutes=5)
    path = scratch_path(spark, name)
    upsert_files(_stats(spark, [(t0, t0 + five, 1, 1, 1.0), (t0 + five, t0 + 2 * five, 4, 4, 4.0),
                                (t1, t1 + five, 2, 2, 2.0)]), path, REALTIME_KEYS, "window_day")
    return path, t0, t1, five


def _pv(spark, path):
    return {r.window_start: r.pv for r in read_table(spark, path).collect()}


def test_crash_before_the_pointer_loses_nothing(spark, monkeypatch):
    path, t0, t1, five = _three_windows(spark, "t-crash")
    before = _pv(spark, path)
    batch = _stats(spark, [(t0, t0 + five, 9, 9, 9.0)])

    def crash(*args):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(tables, "_write_pointer", crash)
        try:
            upsert_files(batch, path, REALTIME_KEYS, "window_day")
        except RuntimeError:
            pass
    assert _pv(spark, path) == before                 # nothing half done, every day there
    upsert_files(batch, path, REALTIME_KEYS, "window_day")
    assert _pv(spark, path) == {**before, t0: 9}


def test_copies_left_by_other_runs_are_not_taken(spark):
    path, t0, t1, five = _three_windows(spark, "t-foreign")
    # What another run wrote without finishing, also under a name of this batch's number.
    for version in ("0", "batch-7"):
        _stats(spark, [(t0, t0 + five, 5, 5, 5.0)]).write.partitionBy("window_day").parquet(f"{path}/version={version}")
    upsert_files(_stats(spark, [(t1 + five, t1 + 2 * five, 8, 8, 8.0)]), path, REALTIME_KEYS, "window_day")
    assert _pv(spark, path) == {t0: 1, t0 + five: 4, t1: 2, t1 + five: 8}


def test_readers_of_the_table_before_a_batch_keep_their_files(spark):
    path, t0, t1, five = _three_windows(spark, "t-reader")
    reader = read_table(spark, path)
    upsert_files(_stats(spark, [(t0, t0 + five, 9, 9, 9.0)]), path, REALTIME_KEYS, "window_day")
    assert {r.pv for r in reader.collect()} == {1, 4, 2}
    for i in range(4):                                # older versions go, the table stays
        upsert_files(_stats(spark, [(t0, t0 + five, i, i, 1.0)]), path, REALTIME_KEYS, "window_day")
    assert _pv(spark, path) == {t0: 3, t0 + five: 4, t1: 2}
    folders = [n for n in tables.list_names(spark, path) if n.startswith("version=")]
    assert len(folders) <= 4


def test_a_batch_of_one_day_reads_one_folder_of_many(spark, monkeypatch):
    path = scratch_path(spark, "t-400")
    t, five = dt.datetime(2024, 1, 1), dt.timedelta(minutes=5)
    days = [t + dt.timedelta(days=d) for d in range(400)]
    upsert_files(_stats(spark, [(d, d + five, i, 1, 1.0) for i, d in enumerate(days)]), path, REALTIME_KEYS, "window_day")
    # Files of the other days can't be read any more: nothing but the touched day may be opened.
    (name,) = tables._pointers(spark, path)
    folders = tables._read_pointer(spark, path, name).folders
    assert len(folders) == 400
    import glob
    for folder, version in folders.items():
        if folder != "window_day=2024-02-01":
            for f in glob.glob(f"{path}/version={version}/{folder}/*.parquet"):
                with open(f, "wb") as fh:
                    fh.write(b"no parquet")
    seen = []
    plain = tables._load

    def load(spark, path, pointer):
        df = plain(spark, path, pointer)
        seen.append([f.split("/")[-2] for f in df.inputFiles()])
        return df
    monkeypatch.setattr(tables, "_load", load)
    day = dt.datetime(2024, 2, 1)
    upsert_files(_stats(spark, [(day + five, day + 2 * five, 7, 7, 7.0)]), path, REALTIME_KEYS, "window_day")
    assert seen == [["window_day=2024-02-01"]]
    got = tables.read_partitions(spark, path, "window_day", ["2024-02-01"]).collect()
    assert sorted((r.window_start, r.pv) for r in got) == [(day, 31), (day + five, 7)]
    assert len(tables.partition_names(spark, path)) == 400


def test_partition_values_that_need_escaping_and_null(spark):
    path = scratch_path(spark, "t-escape")
    schema = "k long, v long, part string"
    rows = [(1, 1, "a/b=c d%"), (2, 2, None), (3, 3, "plain"), (4, 4, "ü:x")]
    upsert_files(spark.createDataFrame(rows, schema), path, ["k"], "part")
    upsert_files(spark.createDataFrame([(1, 10, "a/b=c d%"), (2, 20, None), (5, 50, "ü:x")], schema), path, ["k"], "part")
    got = {r.k: (r.v, r.part) for r in read_table(spark, path).collect()}
    assert got == {1: (10, "a/b=c d%"), 2: (20, None), 3: (3, "plain"), 4: (4, "ü:x"), 5: (50, "ü:x")}


def test_a_pointer_without_schema_is_still_read(spark):
    import json

    path, t0, t1, five = _three_windows(spark, "t-old-pointer")
    (name,) = tables._pointers(spark, path)
    folders = tables._read_pointer(spark, path, name).folders
    with open(f"{path}/_pointer/{name}", "w") as fh:                # as written before the schema was kept
        fh.write(json.dumps(folders))
    crc = f"{path}/_pointer/.{name}.crc"
    import os
    if os.path.exists(crc):
        os.remove(crc)
    assert _pv(spark, path) == {t0: 1, t0 + five: 4, t1: 2}
    upsert_files(_stats(spark, [(t1, t1 + five, 9, 9, 9.0)]), path, REALTIME_KEYS, "window_day")
    assert _pv(spark, path) == {t0: 1, t0 + five: 4, t1: 9}


def test_a_key_twice_in_a_batch(spark):
    import pytest

    path, t0, t1, five = _three_windows(spark, "t-twice")
    twice = _stats(spark, [(t0, t0 + five, 7, 7, 7.0), (t0, t0 + five, 6, 6, 6.0)])
    with pytest.raises(ValueError, match="key twice"):
        upsert_files(twice, path, REALTIME_KEYS, "window_day")
    upsert_files(twice, path, REALTIME_KEYS, "window_day", order_by="pv")
    assert _pv(spark, path)[t0] == 7


def test_a_group_of_rows_is_replaced_as_a_whole(spark):
    path = scratch_path(spark, "t-group")
    schema = "report_date date, rank int, report_month string"
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(day, 1, "2024-01"), (day, 2, "2024-01"), (other, 1, "2024-01")]
    upsert_files(spark.createDataFrame(rows, schema), path, DAILY_KEYS, "report_month", many_per_key=True)
    upsert_files(spark.createDataFrame(rows[:1], schema), path, DAILY_KEYS, "report_month", many_per_key=True)
    assert sorted((r.report_date, r.rank) for r in read_table(spark, path).collect()) == [(day, 1), (other, 1)]


def test_newest_partitions_only(spark):
    from shopstream.plans import serving

    path = scratch_path(spark, "t-newest")
    t = dt.datetime(2024, 1, 1)
    rows = [(t + dt.timedelta(days=d, minutes=m), t + dt.timedelta(days=d, minutes=m + 5), d, m, 1.0)
            for d in range(12) for m in range(10)]
    upsert_files(_stats(spark, rows), path, REALTIME_KEYS, "window_day")
    df = serving.newest_rows(spark, path, 30)
    assert {r.window_start.day for r in df.collect()} == {9, 10, 11, 12}
    assert all("2024-01-0%d" % d not in "".join(df.inputFiles()) for d in range(1, 9))
    assert len(serving.latest_windows(df).collect()) == 30
    assert serving.newest_rows(spark, path, 1000).count() == 120


def test_landing_with_agent_files_and_unknown_suffixes(spark):
    import os
    import gzip

    import pytest

    base = scratch_path(spark, "t-suffix").removeprefix("file://")
    for day, name in (("2023-11-14", "events.1.log"), ("2023-11-15", "part-0.txt"), ("2023-11-16", "e.log.gz")):
        os.makedirs(f"{base}/dt={day}/hour=22")
        opener = gzip.open if name.endswith(".gz") else open
        with opener(f"{base}/dt={day}/hour=22/{name}", "wt") as fh:
            fh.write(SAMPLE_MESSAGES[0] + "\n")
    assert files.read_raw_landing(spark, base).count() == 3
    assert files.read_raw_landing(spark, base, dates=["2023-11-14", "2030-01-01"]).count() == 1
    with pytest.raises(ValueError, match="none matches"):
        files.read_raw_landing(spark, base, dates=["2023-11-14"], suffix="*.txt")
    with pytest.raises(ValueError, match="none matches"):
        files.read_raw_landing(spark, base, suffix="*.txt").count()
    os.makedirs(f"{base}/_spark_metadata")
    with pytest.raises(ValueError, match="commit log"):
        files.read_raw_landing(spark, base)
    with pytest.raises(ValueError, match="commit log"):
        files.write_raw_landing(messages_df(spark, SAMPLE_MESSAGES), base)


def test_emptied_day_leaves_no_old_rows(spark):
    b = decode_messages(messages_df(spark, SAMPLE_MESSAGES))
    base = scratch_path(spark, "t-emptied")
    for day in ("2023-11-14", "2023-11-15"):
        files.write_warehouse(b.withColumn("dt", F.lit(day)), base)
    files.write_warehouse(b.limit(0).withColumn("dt", F.lit("2023-11-14")), base, dates=["2023-11-14"])
    assert {str(r.dt) for r in files.read_warehouse(spark, base).collect()} == {"2023-11-15"}
