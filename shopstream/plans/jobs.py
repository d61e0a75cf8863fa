"""Job entry points (spark-submit): the daily batch job, the realtime job and the landing job.

Daily job, for one or many days in one pass:
    landing JSON (dt=/hour=) -> warehouse Parquet (dynamic overwrite of those
    days) -> one aggregate -> report, top products and category sales -> keyed upserts

Realtime job:
    messages (Kafka or files) -> window stats -> foreachBatch upsert

Landing job:
    messages (Kafka or files) -> text files under dt=/hour= of arrival

    python -m shopstream.plans.jobs daily --landing L --warehouse W --reports R [--top-products T]
        [--category-sales C] [--unreadable G] [--date D ...] [--timezone Z] [--jdbc-url U --jdbc-table T ...]
    python -m shopstream.plans.jobs realtime (--bootstrap-servers H:P | --path DIR) --checkpoint C
        (--table T | --jdbc-url U) [--mode M] [--exact-uv] [--kafka-option k=v ...]
    python -m shopstream.plans.jobs landing (--bootstrap-servers H:P | --path DIR) --landing L --checkpoint C
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.jsonfns import unreadable
from shopstream.functions.money import odd_amount
from shopstream.functions.timefns import odd_time
from shopstream.operators import daily
from shopstream.schema import DAILY_KEYS, DAILY_REPORTS_DDL, REALTIME_STATS_DDL
from shopstream.sources import files
from shopstream.sources.tables import ensure_jdbc_table, upsert_files, upsert_jdbc

log = logging.getLogger("shopstream.jobs")


def default_dates(zone: str = "UTC") -> list[str]:
    """Yesterday in ``zone``, the day the nightly run reports on."""
    return [(dt.datetime.now(ZoneInfo(zone)).date() - dt.timedelta(days=1)).isoformat()]


@dataclass
class DailyOutputs:
    report: DataFrame           # daily_reports rows
    top_products: DataFrame     # top 10 items per day
    category_sales: DataFrame   # sales per category per day


def daily_outputs(facts: DataFrame) -> DailyOutputs:
    """All results of the days of ``daily.daily_facts``."""
    return DailyOutputs(
        report=daily.report_of(facts),
        top_products=daily.top_products_of(facts),
        category_sales=daily.category_sales_of(facts),
    )


def land_to_warehouse(
    spark: SparkSession, landing: str, warehouse: str, dates: Sequence[str] | None,
    suffix: str = files.LANDING_SUFFIX, checks: Observation | None = None,
) -> DataFrame:
    """Convert the landed days to Parquet and return the warehouse rows of those days.

    ``checks`` takes the counts of odd input from the pass that writes them.
    """
    raw = files.read_raw_landing(spark, landing, dates, suffix=suffix).drop("hour")
    if checks is not None:
        raw = raw.observe(checks, F.count_if(unreadable()).alias("unreadable"), F.count_if(odd_time()).alias("odd_times"),
                          F.count_if(odd_amount("amount")).alias("odd_amounts"))
    many_days = dates is None or len(dates) > 1
    files.write_warehouse(
        raw.withColumn("dt", F.date_format("dt", "yyyy-MM-dd")), warehouse, cluster_days=many_days, dates=dates
    )
    return files.read_warehouse(spark, warehouse, dates)


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("report_month", F.date_format("report_date", "yyyy-MM"))


def _store_days(rows: DataFrame, path: str, many: bool = False) -> None:
    """Put the days of ``rows`` into the file table, in place of what it has for them."""
    upsert_files(_with_month(rows), path, DAILY_KEYS, "report_month", many_per_key=many)


def run_daily(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    reports: str | None = None,
    dates: Sequence[str] | None = None,
    jdbc: dict[str, str] | None = None,
    suffix: str = files.LANDING_SUFFIX,
    top_products: str | None = None,
    category_sales: str | None = None,
    unreadable_lines: str | None = None,
) -> DailyOutputs:
    """The nightly job. ``dates=None`` means every landed day.

    The warehouse is scanned once, into ``daily_facts``, of which every result is made; it
    is kept for the stores of this run. Odd input is counted while the days are converted.
    The report is upserted by ``report_date`` into a file table at ``reports``
    and/or a JDBC table (``jdbc`` has url, dbtable, credentials and optionally
    dialect, max_connections and ddl). The ten best products and the sales by
    category go to file tables at ``top_products`` and ``category_sales``. Lines of
    which nothing can be read go to Parquet at ``unreadable_lines``, by ``dt``. A
    failed write raises.
    """
    checks = Observation("input_checks")
    rows = land_to_warehouse(spark, landing, warehouse, dates, suffix, checks)
    facts = daily.daily_facts(rows, day_by="arrival").persist(StorageLevel.MEMORY_AND_DISK)
    out = daily_outputs(facts)
    report = out.report
    if reports and jdbc:
        report = report.persist(StorageLevel.MEMORY_AND_DISK)  # a row a day, for both sinks
    try:
        if reports:
            _store_days(report, reports)
        if jdbc:
            opts = dict(jdbc)
            url, table = opts.pop("url"), opts.pop("dbtable")
            dialect, most, ddl = opts.pop("dialect", "merge"), int(opts.pop("max_connections", 8)), opts.pop("ddl", None)
            if ddl:
                ensure_jdbc_table(spark, url, table, ddl, opts)
            upsert_jdbc(report, url, table, DAILY_KEYS, opts, dialect=dialect, max_connections=most)
        if top_products:
            _store_days(out.top_products, top_products, many=True)
        if category_sales:
            _store_days(out.category_sales, category_sales, many=True)
    finally:
        report.unpersist()
        facts.unpersist()
    if unreadable_lines:
        files.write_days(files.read_unreadable(spark, landing, dates, suffix), unreadable_lines, dates)
    log.info("daily report written for %s; %s", "all days" if dates is None else ",".join(dates), checks.get)
    return out


def _pairs(values: Sequence[str] | None) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values or [])


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="shopstream.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--timezone", default="UTC", help="zone of landing days and of the default date")
    jdbc = argparse.ArgumentParser(add_help=False)
    jdbc.add_argument("--jdbc-url")
    jdbc.add_argument("--jdbc-table")
    jdbc.add_argument("--jdbc-dialect", default="merge", choices=["merge", "mysql"])
    jdbc.add_argument("--jdbc-connections", type=int, default=8)
    jdbc.add_argument("--jdbc-option", action="append", metavar="K=V", help="user, password, driver, ...")
    jdbc.add_argument("--jdbc-create", action="store_true", help="create the table if the database has none")
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--bootstrap-servers")
    source.add_argument("--topic", default="user_behavior")
    source.add_argument("--path", help="directory of message files instead of Kafka")
    source.add_argument("--starting-offsets", default="latest")
    source.add_argument("--kafka-option", action="append", metavar="K=V", help="for example maxOffsetsPerTrigger=100000")
    source.add_argument("--checkpoint", required=True, help="the query's own folder on shared storage")
    source.add_argument("--max-file-age", help="with --path: leave out files older than the newest by more than this")
    d = sub.add_parser("daily", parents=[common, jdbc])
    d.add_argument("--landing", required=True)
    d.add_argument("--warehouse", required=True)
    d.add_argument("--reports")
    d.add_argument("--top-products")
    d.add_argument("--category-sales")
    d.add_argument("--unreadable", help="folder for landed lines of which nothing can be read")
    d.add_argument("--date", action="append", help="yyyy-MM-dd; default yesterday in the zone")
    d.add_argument("--suffix", default=files.LANDING_SUFFIX)
    r = sub.add_parser("realtime", parents=[common, jdbc, source])
    r.add_argument("--table", help="file table; or give --jdbc-url")
    r.add_argument("--mode", default="update", choices=["update", "complete", "append"])
    r.add_argument("--exact-uv", action="store_true",
                   help="exact distinct users per window (append mode, final rows)")
    r.add_argument("--panes", help="file table of minute panes: state is a row for each minute instead of each window")
    r.add_argument("--ahead-rows", help="folder for rows whose clock is far ahead and for unreadable and damaged messages; "
                                        "default beside the checkpoint")
    r.add_argument("--no-ahead-rows", action="store_true", help="only count such rows, keep none")
    land = sub.add_parser("landing", parents=[common, source])
    land.add_argument("--landing", required=True)
    land.add_argument("--archive", help="with --path: landed files move to this folder outside of it")
    return ap


def ahead_rows_folder(args: argparse.Namespace) -> str | None:
    """Where the realtime job keeps what it can't count (``side_rows``); None if it is told to keep none."""
    if args.no_ahead_rows:
        return None
    return args.ahead_rows or f"{args.checkpoint.rstrip('/')}-ahead-rows"


def _main(argv: Sequence[str] | None = None) -> None:
    from shopstream.streaming.monitor import ProgressLogger
    from shopstream.streaming.realtime import (
        read_message_stream,
        realtime_jdbc_sink,
        realtime_table_sink,
        start_pane_stats,
        start_raw_landing,
        start_realtime_stats,
        start_side_rows,
    )

    ap = _parser()
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(f"shopstream-{args.job}") \
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.job == "daily":
        jdbc = None
        if args.jdbc_url:
            jdbc = {"url": args.jdbc_url, "dbtable": args.jdbc_table or "daily_reports", "dialect": args.jdbc_dialect,
                    "max_connections": str(args.jdbc_connections), **_pairs(args.jdbc_option),
                    **({"ddl": DAILY_REPORTS_DDL} if args.jdbc_create else {})}
        if not (args.reports or jdbc):
            ap.error("daily needs --reports or --jdbc-url")
        run_daily(spark, args.landing, args.warehouse, args.reports, args.date or default_dates(args.timezone),
                  jdbc=jdbc, suffix=args.suffix, top_products=args.top_products, category_sales=args.category_sales,
                  unreadable_lines=args.unreadable)
        return
    spark.streams.addListener(ProgressLogger())
    messages = read_message_stream(spark, bootstrap_servers=args.bootstrap_servers, topic=args.topic, path=args.path,
                                   starting_offsets=args.starting_offsets, kafka_options=_pairs(args.kafka_option),
                                   archive=getattr(args, "archive", None), max_file_age=args.max_file_age)
    if args.job == "landing":
        start_raw_landing(messages, args.landing, args.checkpoint, zone=args.timezone).awaitTermination()
        return
    ahead_rows = ahead_rows_folder(args)
    if ahead_rows:
        start_side_rows(messages, ahead_rows, f"{args.checkpoint.rstrip('/')}-ahead")
    mode = "append" if args.exact_uv else args.mode
    if args.panes:
        if args.exact_uv or args.jdbc_url or not args.table:
            ap.error("--panes goes with --table, and not with --exact-uv")
        start_pane_stats(messages, args.panes, args.table, args.checkpoint, mode=mode)
        spark.streams.awaitAnyTermination()
        return
    if args.jdbc_url:
        table, props = args.jdbc_table or "realtime_stats", _pairs(args.jdbc_option)
        if args.jdbc_create:
            ensure_jdbc_table(spark, args.jdbc_url, table, REALTIME_STATS_DDL, props)
        sink = realtime_jdbc_sink(args.jdbc_url, table, props, args.jdbc_dialect, args.jdbc_connections)
    elif args.table:
        sink = realtime_table_sink(args.table, skip_unchanged=(mode == "complete"))
    else:
        ap.error("realtime needs --table or --jdbc-url")
    start_realtime_stats(messages, sink, args.checkpoint, mode=mode, exact_uv=args.exact_uv)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    _main()
