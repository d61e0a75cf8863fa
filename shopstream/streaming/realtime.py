"""Structured Streaming jobs: realtime window stats and raw landing.

Source    Kafka topic (``format("kafka")``, needs the Kafka connector on the
          classpath) or a directory of JSON-lines files; both give a ``value``
          column and an ``arrival`` instant.
Stats     decode -> event time -> 30-minute watermark -> 5-minute windows
          sliding by 1 minute -> pv / approximate uv / sales, written by a
          ``foreachBatch`` sink that upserts by window.
Landing   raw messages appended as text under ``dt=/hour=`` of arrival.

Output modes:
``update``    (default) each trigger emits the windows that changed; state of
              windows older than the watermark is dropped, and rows later than
              the watermark are dropped with it.
``complete``  every trigger re-emits all windows; nothing is ever evicted or
              dropped, so state grows without bound (the original job's mode).

State per window is a click count, a HyperLogLog buffer and a sum. In
``update`` mode the watermark bounds it to the last ~35 windows, so the default
state store is enough; a long-running ``complete`` query keeps every window, so
it starts with the RocksDB state store, which holds state outside the heap and
checkpoints only what a batch changed (``state_store``). A checkpoint keeps the
store it was begun with.

Panes (``start_pane_stats``): state is one row for each minute instead of one
for each window, a fifth, with a mergeable sketch of its users. Changed panes
go to a table; windows that hold one are put together from five panes there.

What can't be counted is not lost: messages of which nothing can be read and
rows whose clock is far ahead of their arrival are counted in the progress and
kept in a side table (``start_side_rows``). Both queries decide by the same
``arrival``, a property of the message (broker time, or the time its file was
written), so at any trigger times each row is in exactly one of the two.

A checkpoint location is required: restarts resume from committed offsets and
state instead of starting over. Stateful shuffles use the session's
``spark.sql.shuffle.partitions`` at the first start; it is then fixed by the
checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream.functions.jsonfns import damaged, decode_messages, unreadable
from shopstream.functions.timefns import odd_time, utc_day
from shopstream.functions.money import money_out, odd_amount, to_money
from shopstream.operators.windows import (
    WINDOW_SIZE,
    WINDOW_SLIDE,
    duration_seconds,
    flatten_windows,
    in_windows,
    pane_aggregates,
    united_windows,
    window_aggregates,
    with_event_time,
)
from shopstream.schema import BEHAVIOR_COLUMNS, BUY, CLICK, REALTIME_KEYS
from shopstream.sources.files import MAX_RECORDS_PER_FILE, landing_columns, refuse_commit_log
from shopstream.sources.tables import (
    delete_path,
    list_names,
    move_path,
    read_partitions,
    read_table,
    upsert_files,
    upsert_jdbc,
)

# The lateness bound, trigger intervals and topic of the jobs.
WATERMARK = "30 minutes"
STATS_TRIGGER = "10 seconds"
LANDING_TRIGGER = "60 seconds"
TOPIC = "user_behavior"
#: How far a row's event time may lie after its arrival.
AHEAD = "1 hours"
#: Name of the counts of odd input in a query's progress.
INPUT_CHECKS = "input_checks"

# Spark's state stores and their settings.
STATE_STORES = {
    "memory": {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"},
    "rocksdb": {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"},
}

BatchSink = Callable[[DataFrame, int], None]


def read_message_stream(
    spark: SparkSession,
    *,
    bootstrap_servers: str | None = None,
    topic: str = TOPIC,
    starting_offsets: str = "latest",
    path: str | None = None,
    max_files_per_trigger: int | None = None,
    kafka_options: dict[str, str] | None = None,
    archive: str | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """A streaming DataFrame of ``value`` (message text) and ``arrival``.

    With ``bootstrap_servers`` the messages come from Kafka and ``arrival`` is
    the broker timestamp; with ``path`` they are lines of the files that
    appear in that directory and ``arrival`` is the time the file was written.
    Either is the same for every query and every attempt that reads the message.

    A directory source lists its folder at each trigger. ``archive`` moves files
    there once their batch is done, so the folder does not grow with the stream's
    history (the archive must lie outside of it, and one query may read the folder);
    ``max_file_age`` leaves out files that are older than the newest by more than this.
    """
    if bootstrap_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        for k, v in (kafka_options or {}).items():
            reader = reader.option(k, v)
        raw = reader.load()
        return raw.select(F.col("value").cast("string").alias("value"),
                          F.col("timestamp").alias("arrival"))
    if not path:
        raise ValueError("need bootstrap_servers or path")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("arrival"))


def _is_ahead(ahead: str) -> Column:
    limit = F.unix_seconds("arrival") + F.lit(duration_seconds(ahead))
    return F.coalesce(F.unix_seconds("event_time") > limit, F.lit(False))


def _checked(messages: DataFrame, ahead: str | None) -> DataFrame:
    """Decoded rows with event time; what can't be counted is counted here, rows far ahead of their arrival left out."""
    rows = with_event_time(decode_messages(messages.select("value", "arrival"), keep_corrupt=True))
    far = _is_ahead(ahead) if ahead else F.lit(False)
    rows = rows.observe(INPUT_CHECKS, F.count_if(unreadable()).alias("unreadable"), F.count_if(damaged()).alias("damaged"),
                        F.count_if(odd_time()).alias("odd_times"), F.count_if(odd_amount("amount")).alias("odd_amounts"),
                        F.count_if(far).alias("rows_ahead"))
    return rows.where(~far) if ahead else rows


def _trigger(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time) if processing_time else writer


def side_rows(messages: DataFrame, ahead: str | None = AHEAD) -> DataFrame:
    """What the stats leave out: ``reason`` (unreadable, damaged or ahead), ``message`` as it came, ``arrival``,
    the behavior columns and ``event_time``. A damaged message still counts with the fields it has."""
    rows = with_event_time(decode_messages(messages.select("value", F.col("value").alias("message"), "arrival"), keep_corrupt=True))
    reason = F.when(unreadable(), F.lit("unreadable"))
    if ahead:
        reason = reason.when(_is_ahead(ahead), F.lit("ahead"))
    reason = reason.when(damaged(), F.lit("damaged"))
    return rows.select(reason.alias("reason"), "message", "arrival", *BEHAVIOR_COLUMNS, "event_time").where("reason IS NOT NULL")


def start_side_rows(messages: DataFrame, path: str, checkpoint: str, *, ahead: str | None = AHEAD,
                    processing_time: str | None = LANDING_TRIGGER, available_now: bool = False) -> StreamingQuery:
    """Append ``side_rows`` to a Parquet folder; ``ahead`` as in the stats query beside it."""
    writer = side_rows(messages, ahead).writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint)
    return _trigger(writer, processing_time, available_now).start()


def realtime_stats_stream(
    messages: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
    exact_uv: bool = False,
    ahead: str | None = AHEAD,
) -> DataFrame:
    """Streaming pv / uv / sales per window.

    Rows whose event time is later than their arrival by more than ``ahead``
    don't count and don't move the watermark: one wrong clock would otherwise
    close everybody's windows. ``start_side_rows`` keeps them; ``None`` lets
    them count. Times and amounts that can't be read count as null
    (``odd_time``, ``odd_amount``). These, unreadable and damaged messages are
    counted per batch under ``INPUT_CHECKS`` in the query's progress.

    Default: one stateful aggregate with a HyperLogLog uv; works with the
    ``update`` and ``complete`` output modes.

    ``exact_uv=True``: two chained stateful aggregates, (window, user) and then
    window; the second groups by a ``slide``-wide window over
    ``window_time(window)`` so the watermark carries over. Spark allows such a
    chain only in ``append`` mode: each window is emitted once, final and
    exact, after the watermark passes its end (a delay of about the lateness
    bound). State holds the open windows' users, bounded by the watermark.
    """
    behavior = _checked(messages, ahead).withWatermark("event_time", watermark)
    if not exact_uv:
        windowed = behavior.groupBy(F.window("event_time", size, slide).alias("window")).agg(
            *window_aggregates(exact_uv=False)
        )
        return flatten_windows(windowed)
    per_user = behavior.groupBy(F.window("event_time", size, slide).alias("window"), "user_id").agg(
        F.count_if(F.col("behavior_type") == F.lit(CLICK)).alias("pv"),
        F.sum(
            F.when(F.col("behavior_type") == F.lit(BUY), to_money("amount")).otherwise(F.lit(0))
        ).alias("sales"),
    )
    per_window = per_user.groupBy(F.window(F.window_time("window"), slide).alias("tail")).agg(
        F.sum("pv").alias("pv"), F.count("user_id").alias("uv"), F.sum("sales").alias("sales")
    )
    end = F.col("tail.end")
    return per_window.select(
        F.timestamp_seconds(F.unix_seconds(end) - F.lit(duration_seconds(size))).alias("window_start"),
        end.alias("window_end"),
        F.col("pv").cast("long").alias("pv"),
        F.col("uv").cast("long").alias("uv"),
        money_out("sales").alias("sales"),
    )


def realtime_table_sink(path: str, skip_unchanged: bool = False) -> BatchSink:
    """``foreachBatch`` function upserting window rows into a Parquet table
    partitioned by the UTC day of ``window_start``.

    ``skip_unchanged`` (use it with ``complete`` mode, where every trigger
    re-emits every window): rows equal to what the table already holds are
    dropped first, so only the days whose windows changed are rewritten.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("window_day", utc_day("window_start"))
        existing = read_table(batch.sparkSession, path) if skip_unchanged else None
        if existing is not None:
            same = [rows[c].eqNullSafe(existing[c]) for c in existing.columns]
            cond = same[0]
            for c in same[1:]:
                cond = cond & c
            rows = rows.join(existing, cond, "left_anti")
        upsert_files(rows, path, REALTIME_KEYS, "window_day")

    return sink


def realtime_jdbc_sink(url: str, table: str = "realtime_stats",
                       properties: dict[str, str] | None = None,
                       dialect: str = "merge", max_connections: int = 8) -> BatchSink:
    """``foreachBatch`` function upserting window rows into a relational table
    (primary key window_start, window_end): staged by Spark's JDBC writer,
    applied with one MERGE. A replayed batch re-stages and re-merges."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_jdbc(batch, url, table, REALTIME_KEYS, properties, dialect=dialect,
                    max_connections=max_connections)

    return sink


def start_realtime_stats(
    messages: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    *,
    mode: str = "update",
    processing_time: str | None = STATS_TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    exact_uv: bool = False,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
    ahead: str | None = AHEAD,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start the realtime window query with ``sink`` as its foreachBatch.

    ``state_store``: a name of ``STATE_STORES``; by default ``rocksdb`` for ``complete`` mode, whose
    state only grows, and the session's own for the others.
    """
    allowed = ("append",) if exact_uv else ("update", "complete")
    if mode not in allowed:
        raise ValueError(f"mode must be one of {allowed} (exact_uv={exact_uv})")
    stats = realtime_stats_stream(messages, size, slide, watermark, exact_uv=exact_uv, ahead=ahead)
    writer = (
        stats.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    with _state_store(messages.sparkSession, state_store or ("rocksdb" if mode == "complete" else None)):
        return _trigger(writer, processing_time, available_now).start()


@contextmanager
def _state_store(spark: SparkSession, name: str | None) -> Iterator[None]:
    """Settings that a query takes over when it starts; the session gets its own back."""
    settings = STATE_STORES[name] if name else {}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---------------------------------------------------------------- panes

def pane_stream(messages: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE, watermark: str = WATERMARK,
                ahead: str | None = AHEAD) -> DataFrame:
    """Streaming ``pane_start, pv, sales, users`` for each pane of ``slide``: click count, sum, sketch of users.

    A pane stays open until every window that holds it is behind the watermark, so no row that counts in
    one of the windows of ``realtime_stats_stream`` is dropped here.
    """
    keep = f"{duration_seconds(watermark) + duration_seconds(size) - duration_seconds(slide)} seconds"
    rows = _checked(messages, ahead).withWatermark("event_time", keep)
    return rows.groupBy(F.window("event_time", slide).alias("pane")) \
        .agg(*pane_aggregates()).select(F.col("pane.start").alias("pane_start"), "pv", "sales", "users")


def pane_sink(panes: str, table: str, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE) -> BatchSink:
    """``foreachBatch`` function: changed panes go to the file table ``panes`` (by UTC day), then the windows that
    hold one of them are united from that table and upserted into ``table``. Only the days of those panes are
    read, and a replayed batch gives the same rows."""
    reach = duration_seconds(size) - duration_seconds(slide)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.withColumn("pane_day", utc_day("pane_start")).persist()
        try:
            upsert_files(changed, panes, ["pane_start"], "pane_day")
            # Days from the first pane of the earliest window to the last pane of the latest one.
            at = F.unix_seconds("pane_start")
            near = F.array(*(utc_day(F.timestamp_seconds(at + F.lit(s))) for s in (-reach, reach)))
            days = [r[0] for r in changed.select(F.explode(near)).distinct().collect()]
            if not days:
                return
            stored = read_partitions(spark, panes, "pane_day", [str(d) for d in days])
            hit = in_windows(changed.select("pane_start"), size, slide).select("win").distinct()
            rows = united_windows(in_windows(stored, size, slide).join(hit, "win", "left_semi"), size)
            upsert_files(rows.withColumn("window_day", utc_day("window_start")), table, REALTIME_KEYS, "window_day")
        finally:
            changed.unpersist()

    return sink


def start_pane_stats(messages: DataFrame, panes: str, table: str, checkpoint: str, *, mode: str = "update",
                     processing_time: str | None = STATS_TRIGGER, available_now: bool = False, size: str = WINDOW_SIZE,
                     slide: str = WINDOW_SLIDE, watermark: str = WATERMARK, ahead: str | None = AHEAD) -> StreamingQuery:
    """The realtime windows with a state row for each pane: file tables ``panes`` and ``table`` (the serving table)."""
    if mode not in ("update", "complete"):
        raise ValueError("mode must be update or complete")
    if duration_seconds(size) % duration_seconds(slide):
        raise ValueError("panes need a size that is a multiple of the slide")
    writer = pane_stream(messages, size, slide, watermark, ahead).writeStream \
        .foreachBatch(pane_sink(panes, table, size, slide)).outputMode(mode).option("checkpointLocation", checkpoint)
    with _state_store(messages.sparkSession, "rocksdb" if mode == "complete" else None):
        return _trigger(writer, processing_time, available_now).start()


def landing_sink(base: str, zone: str = "UTC") -> BatchSink:
    """``foreachBatch`` function that puts a batch's messages into plain files of the landing folders.

    The batch is written beside the landing and its files are moved in under
    names that carry the query and the batch; a replay first takes away what an
    earlier attempt of the batch moved. So each message lands once, no commit log
    governs the folder, and other writers may land there too. A batch has few
    files (about one for each folder and task).
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        tag = f"stream-{query}-{batch_id:09d}"
        draft = f"{base.rstrip('/')}/_landing/{tag}"
        batch.select(*landing_columns(F.col("value"), F.col("arrival"), zone)).hint("rebalance", "dt", "hour") \
            .write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE) \
            .partitionBy("dt", "hour").text(draft)
        for day in [n for n in list_names(spark, draft) if n.startswith("dt=")]:
            for hour in list_names(spark, f"{draft}/{day}"):
                target = f"{base.rstrip('/')}/{day}/{hour}"
                for old in list_names(spark, target):
                    if old.startswith(f"{tag}-"):
                        delete_path(spark, f"{target}/{old}")
                parts = [n for n in list_names(spark, f"{draft}/{day}/{hour}") if not n.startswith((".", "_"))]
                for i, name in enumerate(parts):
                    suffix = name[name.index("."):]
                    move_path(spark, f"{draft}/{day}/{hour}/{name}", f"{target}/{tag}-{i:05d}{suffix}")
        delete_path(spark, draft)

    return sink


def start_raw_landing(
    messages: DataFrame,
    base: str,
    checkpoint: str,
    *,
    processing_time: str | None = LANDING_TRIGGER,
    available_now: bool = False,
    zone: str = "UTC",
) -> StreamingQuery:
    """Append raw messages as text files under ``base/dt=YYYY-MM-DD/hour=HH``
    of the arrival instant in ``zone``, each micro-batch exactly once."""
    refuse_commit_log(messages.sparkSession, base)
    writer = messages.writeStream.foreachBatch(landing_sink(base, zone)).option("checkpointLocation", checkpoint)
    return _trigger(writer, processing_time, available_now).start()
