"""Hop-window statistics: golden sample, edge cases, strategy equivalence."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_MESSAGES, SMOKE_DIR, behavior_df, messages_df
from shopstream.functions.jsonfns import decode_messages
from shopstream.functions.timefns import utc_wall_clock
from shopstream.operators.windows import duration_seconds, window_stats
from shopstream.sources.events import load_behavior


def _ntz(df):
    return df.select(
        utc_wall_clock("window_start").alias("window_start"),
        utc_wall_clock("window_end").alias("window_end"), "pv", "uv", "sales",
    )


def _tuples(df):
    return sorted(tuple(r) for r in _ntz(df).collect())


@pytest.mark.parametrize("strategy", ["panes", "expand"])
def test_sample_golden_windows(spark, strategy):
    b = decode_messages(messages_df(spark, SAMPLE_MESSAGES))
    got = _tuples(window_stats(b, strategy=strategy))
    base = dt.datetime(2023, 11, 14, 22, 0)
    want = [
        (base + dt.timedelta(minutes=m), base + dt.timedelta(minutes=m + 5), 2, 5, 99.9)
        for m in range(9, 14)
    ]
    assert got == want


def test_null_time_in_no_window(spark):
    recs = [("u_1", "i", "c", "click", 0, 0.0, None, None),
            ("u_2", "i", "c", "click", 0, 0.0, 60_000, None)]
    got = _tuples(window_stats(behavior_df(spark, recs)))
    assert len(got) == 5 and all(r[2] == 1 and r[3] == 1 for r in got)


def test_sales_zero_without_buys_and_unknown_type(spark):
    recs = [("u_1", "i", "c", "error", 0, 5.0, 0, None)]
    got = _tuples(window_stats(behavior_df(spark, recs)))
    assert {(r[2], r[3], r[4]) for r in got} == {(0, 1, 0.0)}


def _brute(recs, size_s=300, slide_s=60):
    acc = defaultdict(lambda: [0, set(), 0, 0])
    for user, _, _, kind, _, amount, ms, _ in recs:
        if ms is None:
            continue
        t = int(ms / 1000)
        first = (t - size_s) // slide_s + 1
        for q in range(first, t // slide_s + 1):
            a = acc[q * slide_s]
            a[0] += kind == "click"
            if user is not None:
                a[1].add(user)
            if kind == "buy":
                a[2] += round(amount * 100)
            a[3] += 1
    return sorted(
        (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s),
         dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s + size_s), a[0], len(a[1]), a[2] / 100)
        for s, a in acc.items()
    )


def _random_recs(seed, n, day_edge):
    rnd = random.Random(seed)
    base = 1_700_006_400_000 if day_edge else 1_700_000_000_000   # 2023-11-15 00:00 UTC
    recs = []
    for _ in range(n):
        offset = rnd.randint(-15 * 60_000, 15 * 60_000) if day_edge else rnd.randint(0, 3_600_000)
        user = rnd.choice(["u_1", "u_2", "u_3", "u_4", None])
        kind = rnd.choice(["click", "buy", "cart", "fav"])
        amount = round(rnd.uniform(1, 50), 2) if kind == "buy" else 0.0
        recs.append((user, "i_1", "c_1", kind, 0, amount, base + offset, None))
    return recs


@pytest.mark.parametrize("seed,day_edge", [(1, True), (2, True), (3, False)])
def test_panes_match_brute_force(spark, seed, day_edge):
    recs = _random_recs(seed, 400, day_edge)
    got = _tuples(window_stats(behavior_df(spark, recs), strategy="panes"))
    assert got == _brute(recs)


def test_panes_equal_expand_on_events(spark):
    b = load_behavior(spark, SMOKE_DIR)
    assert _tuples(window_stats(b, strategy="panes")) == _tuples(window_stats(b, strategy="expand"))


def test_other_window_sizes(spark):
    recs = _random_recs(7, 300, True)
    df = behavior_df(spark, recs)
    for size, slide in [("10 minutes", "2 minutes"), ("1 hour", "10 minutes"), ("5 minutes", "5 minutes")]:
        a = _tuples(window_stats(df, size, slide, strategy="panes"))
        b = _tuples(window_stats(df, size, slide, strategy="expand"))
        assert a == b, (size, slide)


def test_approx_uv_close(spark):
    b = load_behavior(spark, SMOKE_DIR)
    exact = {r[0]: r[3] for r in _tuples(window_stats(b))}
    approx = {r[0]: r[3] for r in _tuples(window_stats(b, exact_uv=False))}
    assert exact.keys() == approx.keys()
    assert max(abs(exact[k] - approx[k]) for k in exact) <= 2


def test_duration_parse():
    assert duration_seconds("5 minutes") == 300
    assert duration_seconds("1 minute") == 60
    with pytest.raises(ValueError):
        duration_seconds("five minutes")


def test_pane_plan_has_no_expand_of_raw_rows(spark):
    plan = window_stats(load_behavior(spark, SMOKE_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert plan.count("Exchange") == 3


def test_sketch_plan_close_to_exact(spark):
    b = load_behavior(spark, SMOKE_DIR)
    exact = {r[0]: r for r in _tuples(window_stats(b))}
    sketch = {r[0]: r for r in _tuples(window_stats(b, exact_uv=False, strategy="panes"))}
    assert exact.keys() == sketch.keys()
    assert all(exact[k][2] == sketch[k][2] and exact[k][4] == sketch[k][4] for k in exact)
    assert max(abs(exact[k][3] - sketch[k][3]) for k in exact) <= 2
    plan = window_stats(b, exact_uv=False, strategy="panes")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Expand" not in plan
