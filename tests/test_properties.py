"""Property tests: the pane plan equals a brute-force model on random input."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import behavior_df
from test_windows import _brute, _tuples
from shopstream.operators.windows import window_stats

DAY_MS = 86_400_000
BASE = 1_700_006_400_000          # a UTC midnight

record = st.tuples(
    st.sampled_from(["u_1", "u_2", "u_3", None]),
    st.sampled_from(["click", "buy", "cart", "fav", "other"]),
    st.integers(min_value=-20 * 60_000, max_value=20 * 60_000),   # around midnight
    st.sampled_from([0.0, 1.25, 10.5, 99.99]),
    st.booleans(),
)


def _to_rows(draw):
    rows = []
    for user, kind, offset, amount, null_time in draw:
        ms = None if null_time and kind == "other" else BASE + offset
        rows.append((user, "i_1", "c_1", kind, 0, amount if kind == "buy" else 0.0, ms, None))
    return rows


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=60))
def test_pane_plan_matches_model(spark, draw):
    rows = _to_rows(draw)
    assert _tuples(window_stats(behavior_df(spark, rows))) == _brute(rows)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-3 * 60_000, max_value=3 * 60_000), min_size=1, max_size=30))
def test_negative_epoch_times(spark, offsets):
    rows = [("u_1", "i", "c", "click", 0, 0.0, o, None) for o in offsets]
    assert _tuples(window_stats(behavior_df(spark, rows))) == _brute(rows)


def _report_model(rows):
    import datetime as dt
    from collections import defaultdict
    from decimal import Decimal

    days = defaultdict(lambda: {"items": defaultdict(Decimal), "users": defaultdict(set)})
    for user, item, _, kind, _, amount, ms, _ in rows:
        if ms is None:
            continue
        day = (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(ms / 1000))).date()
        d = days[day]
        if user is not None:
            d["users"][kind].add(user)
        if kind == "buy":
            d["items"][item] += Decimal(str(amount))
        else:
            d["items"]            # the day exists even without buys
    out = []
    for day, d in days.items():
        ranked = sorted(d["items"].items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        ranked += [("", Decimal(0))] * (3 - len(ranked))
        total = sum(d["items"].values(), Decimal(0))
        out.append((day, float(total), ranked[0][0], float(ranked[0][1]), ranked[1][0],
                    float(ranked[1][1]), ranked[2][0], float(ranked[2][1]),
                    len(d["users"]["click"]), len(d["users"]["cart"]), len(d["users"]["buy"])))
    return sorted(out)


report_record = st.tuples(
    st.sampled_from(["u_1", "u_2", "u_3", None]),
    st.sampled_from(["i_1", "i_2", "i_3", "i_4"]),
    st.sampled_from(["click", "buy", "cart", "fav", "other"]),
    st.sampled_from([1.0, 2.5, 10.0]),
    st.integers(min_value=0, max_value=3 * DAY_MS),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(report_record, min_size=1, max_size=50))
def test_daily_report_matches_model(spark, draw):
    from shopstream.operators.daily import daily_report

    rows = [(u, i, "c_1", k, 1 if k == "buy" else 0, a if k == "buy" else 0.0, BASE + o, None)
            for u, i, k, a, o in draw]
    got = sorted(tuple(r) for r in daily_report(behavior_df(spark, rows)).collect())
    assert got == _report_model(rows)
