"""Event-time hop-window statistics: pv, uv and sales per window.

pv    number of ``click`` rows
uv    distinct ``user_id`` over all behavior types
sales sum of ``amount`` over ``buy`` rows (0 when there are none)

Two physical strategies produce the same result:

``expand``  Spark's own ``window()``: every row is copied into each of the
            size/slide windows that contain it, then aggregated. Exact uv
            becomes a distinct aggregate keyed by (window, user), so the first
            shuffle carries about size/slide times the pre-aggregated rows.
            This is the only form a streaming query can use.

``panes``   (batch default) rows are first combined per (user, pane), where a
            pane is one slide interval; that shuffle is map-side combined, so a
            hot user or a hot minute shrinks to one row per task. The pane rows
            are then clustered by (user, day block) and ordered by pane; a user
            is counted in a window by its first active pane in that window
            (``lag``), which needs no (window, user) shuffle. Each cluster holds
            at most one day of panes of one user plus a few boundary panes, so
            no group grows with the data. pv and sales are additive and ride
            along. The last aggregation is keyed by window and map-side
            combined as well.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.money import money_out, to_money
from shopstream.functions.timefns import event_time
from shopstream.schema import BUY, CLICK

# The window the realtime job computes.
WINDOW_SIZE = "5 minutes"
WINDOW_SLIDE = "1 minute"

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
_DURATION = re.compile(r"^\s*(\d+)\s*(second|minute|hour|day|week)s?\s*$", re.IGNORECASE)


def duration_seconds(text: str) -> int:
    """``"5 minutes"`` -> 300. Whole multiples of one unit only."""
    m = _DURATION.match(text)
    if not m:
        raise ValueError(f"unsupported duration: {text!r}")
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2).lower()]


def with_event_time(behavior: DataFrame, millis_col: str = "timestamp") -> DataFrame:
    """Add ``event_time`` (TIMESTAMP, whole seconds) from epoch milliseconds."""
    return behavior.withColumn("event_time", event_time(millis_col))


def _is(col: str, value: str):
    return F.col(col) == F.lit(value)


def window_stats(
    behavior: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    *,
    exact_uv: bool = True,
    strategy: str | None = None,
) -> DataFrame:
    """Per-window pv / uv / sales.

    ``behavior`` needs ``user_id``, ``behavior_type``, ``amount`` and either
    ``event_time`` or ``timestamp``. Rows without event time are in no window.
    Returns ``window_start, window_end`` (TIMESTAMP), ``pv, uv`` (long),
    ``sales`` (double).

    ``strategy`` defaults to ``panes`` for exact uv and ``expand`` (HLL++, as
    the stream computes it) for approximate uv. ``panes`` with
    ``exact_uv=False`` is the opt-in sketch plan: one HLL sketch per pane,
    unioned over the panes of each window, so each row is aggregated once
    instead of once per window; its estimator differs from HLL++.
    """
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    strategy = strategy or ("panes" if exact_uv else "expand")
    if strategy not in ("panes", "expand"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "expand" or size_s % slide_s != 0:
        if "event_time" not in behavior.columns:
            behavior = with_event_time(behavior)
        return _expand_window_stats(behavior, size, slide, exact_uv)
    if not exact_uv:
        return _sketch_window_stats(behavior, size_s, slide_s)
    return _pane_window_stats(behavior, size_s, slide_s)


def window_aggregates(exact_uv: bool):
    """The three aggregate expressions of a window (shared with streaming)."""
    uv = F.count_distinct("user_id") if exact_uv else F.approx_count_distinct("user_id")
    sales = F.sum(F.when(_is("behavior_type", BUY), to_money("amount")).otherwise(F.lit(0)))
    return [
        F.count_if(_is("behavior_type", CLICK)).alias("pv"),
        uv.alias("uv"),
        sales.alias("sales"),
    ]


def flatten_windows(windowed: DataFrame) -> DataFrame:
    return windowed.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("pv").cast("long").alias("pv"),
        F.col("uv").cast("long").alias("uv"),
        money_out("sales").alias("sales"),
    )


def _expand_window_stats(behavior: DataFrame, size: str, slide: str, exact_uv: bool) -> DataFrame:
    windowed = behavior.groupBy(F.window("event_time", size, slide).alias("window")).agg(
        *window_aggregates(exact_uv)
    )
    return flatten_windows(windowed)


def _pane_window_stats(behavior: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    n = size_s // slide_s                      # panes per window
    block = max(n, 86_400 // slide_s)          # panes per cluster (one day)

    et = F.col("event_time") if "event_time" in behavior.columns else event_time("timestamp")
    pane = F.floor(F.unix_seconds(et) / F.lit(slide_s)).cast("long")
    per_pane = (
        behavior.select("user_id", pane.alias("pane"), "behavior_type", "amount")
        .where(F.col("pane").isNotNull())
        .groupBy("user_id", "pane")
        .agg(
            F.count_if(_is("behavior_type", CLICK)).alias("pv"),
            F.sum(
                F.when(_is("behavior_type", BUY), to_money("amount")).otherwise(F.lit(0))
            ).alias("sales"),
        )
    )

    # A pane belongs to the cluster of its own day block; panes at the start of
    # a block also serve the windows that open in the previous block.
    own = F.floor(F.col("pane") / F.lit(block)).cast("long")
    blocks = F.when(
        F.col("pane") - own * F.lit(block) < F.lit(n - 1),
        F.array(own, own - F.lit(1)),
    ).otherwise(F.array(own))
    clustered = per_pane.select("*", F.explode(blocks).alias("wblock"))

    by_user = Window.partitionBy("user_id", "wblock").orderBy("pane")
    first_win = F.greatest(F.col("pane") - F.lit(n - 1), F.col("wblock") * F.lit(block))
    last_win = F.least(F.col("pane"), F.col("wblock") * F.lit(block) + F.lit(block - 1))
    spread = clustered.withColumn("prev_pane", F.lag("pane").over(by_user)).select(
        "user_id",
        "pv",
        "sales",
        "prev_pane",
        F.explode(F.sequence(first_win, last_win)).alias("win"),
    )
    # The user counts in window ``win`` at its first active pane in it.
    new_user = (
        F.col("user_id").isNotNull()
        & (F.col("prev_pane").isNull() | (F.col("prev_pane") < F.col("win")))
    )
    per_window = spread.groupBy("win").agg(
        F.sum("pv").alias("pv"),
        F.count_if(new_user).alias("uv"),
        F.sum("sales").alias("sales"),
    )
    start = F.timestamp_seconds(F.col("win") * F.lit(slide_s))
    return per_window.select(
        start.alias("window_start"),
        F.timestamp_seconds(F.col("win") * F.lit(slide_s) + F.lit(size_s)).alias("window_end"),
        F.col("pv").cast("long").alias("pv"),
        F.col("uv").cast("long").alias("uv"),
        money_out("sales").alias("sales"),
    )


def _sketch_window_stats(behavior: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    """Approximate uv from per-pane HLL sketches (pv and sales stay exact)."""
    et = F.col("event_time") if "event_time" in behavior.columns else event_time("timestamp")
    pane = F.floor(F.unix_seconds(et) / F.lit(slide_s)) * F.lit(slide_s)
    per_pane = (
        behavior.select(F.timestamp_seconds(pane).alias("pane_start"), "user_id", "behavior_type", "amount")
        .where(F.col("pane_start").isNotNull())
        .groupBy("pane_start")
        .agg(*pane_aggregates())
    )
    return united_windows(in_windows(per_pane, f"{size_s} seconds", f"{slide_s} seconds"), f"{size_s} seconds")


def pane_aggregates():
    """The aggregates of a pane: click count, sales and a mergeable sketch of its users (shared with streaming)."""
    return [
        F.count_if(_is("behavior_type", CLICK)).alias("pv"),
        F.sum(F.when(_is("behavior_type", BUY), to_money("amount")).otherwise(F.lit(0))).alias("sales"),
        F.hll_sketch_agg("user_id").alias("users"),
    ]


def in_windows(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """A row for each window (``win``, start in epoch seconds) that holds the pane."""
    at, step = F.unix_seconds("pane_start"), duration_seconds(slide)
    return panes.withColumn("win", F.explode(F.sequence(at - F.lit(duration_seconds(size) - step), at, F.lit(step).cast("long"))))


def united_windows(panes: DataFrame, size: str) -> DataFrame:
    """Window rows from the panes of each ``win``; uv is the estimate of the united sketches."""
    per_window = panes.groupBy("win").agg(
        F.sum("pv").alias("pv"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("uv"),
        F.sum("sales").alias("sales"),
    )
    return per_window.select(
        F.timestamp_seconds("win").alias("window_start"),
        F.timestamp_seconds(F.col("win") + F.lit(duration_seconds(size))).alias("window_end"),
        F.col("pv").cast("long").alias("pv"),
        F.col("uv").cast("long").alias("uv"),
        money_out("sales").alias("sales"),
    )
