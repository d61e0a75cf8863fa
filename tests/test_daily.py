"""Daily metrics and the daily report."""

from __future__ import annotations

import datetime as dt

from conftest import SAMPLE_MESSAGES, behavior_df, messages_df
from shopstream.functions.jsonfns import decode_messages
from shopstream.operators import daily

DAY = 1_700_006_400_000          # 2023-11-15 00:00 UTC in ms
D1 = dt.date(2023, 11, 15)
D2 = dt.date(2023, 11, 16)


def rec(user, item, kind, amount=0.0, ms=DAY, cat="c_1"):
    return (user, item, cat, kind, 1 if kind == "buy" else 0, amount, ms, None)


def test_sample_daily_report(spark):
    b = decode_messages(messages_df(spark, SAMPLE_MESSAGES))
    r = daily.daily_report(b).collect()
    assert len(r) == 1
    assert tuple(r[0]) == (dt.date(2023, 11, 14), 99.9, "i_5004", 99.9, "", 0.0, "", 0.0, 2, 1, 1)
    funnel = {(x.behavior_type, x.uv) for x in daily.behavior_funnel(b).collect()}
    assert funnel == {("click", 2), ("cart", 1), ("buy", 1), ("fav", 1)}
    cats = {x.category_id: x.sales for x in daily.category_sales(b).collect()}
    assert cats == {"c_303": 99.9}


def test_ties_go_to_lower_item_and_top_k(spark):
    recs = [rec("u_1", "i_b", "buy", 10.0), rec("u_2", "i_a", "buy", 10.0),
            rec("u_3", "i_c", "buy", 30.0), rec("u_4", "i_d", "buy", 5.0)]
    b = behavior_df(spark, recs)
    top = [(x.rank, x.item_id, x.sales) for x in daily.top_products(b).orderBy("rank").collect()]
    assert top == [(1, "i_c", 30.0), (2, "i_a", 10.0), (3, "i_b", 10.0), (4, "i_d", 5.0)]
    assert [x.item_id for x in daily.top_products(b, k=2).collect()] == ["i_c", "i_a"] or \
        sorted(x.item_id for x in daily.top_products(b, k=2).collect()) == ["i_a", "i_c"]
    r = daily.daily_report(b).first()
    assert (r.top1_product, r.top2_product, r.top3_product) == ("i_c", "i_a", "i_b")
    assert r.total_sales == 55.0 and r.buy_uv == 4


def test_day_without_buys_and_many_days(spark):
    recs = [rec("u_1", "i_1", "click"), rec("u_1", "i_1", "click", ms=DAY + 3_600_000),
            rec("u_2", "i_2", "cart"), rec(None, "i_2", "click"),
            rec("u_9", "i_9", "buy", 12.5, ms=DAY + 86_400_000),
            rec("u_9", "i_9", "weird", 0.0, ms=DAY + 86_400_000)]
    b = behavior_df(spark, recs)
    got = {r.report_date: tuple(r) for r in daily.daily_report(b).collect()}
    assert got[D1] == (D1, 0.0, "", 0.0, "", 0.0, "", 0.0, 1, 1, 0)
    assert got[D2] == (D2, 12.5, "i_9", 12.5, "", 0.0, "", 0.0, 0, 0, 1)
    totals = {r.report_date: r.total_sales for r in daily.total_sales(b).collect()}
    assert totals == {D1: 0.0, D2: 12.5}
    funnel = {(r.report_date, r.behavior_type): r.uv for r in daily.behavior_funnel(b).collect()}
    assert funnel[(D2, "weird")] == 1 and funnel[(D1, "click")] == 1


def test_arrival_day(spark):
    recs = [rec("u_1", "i_1", "buy", 3.0, ms=DAY - 1000)]   # event on the 14th
    b = behavior_df(spark, recs).withColumn("dt", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("2023-11-15"))
    assert daily.daily_report(b, day_by="arrival").first().report_date == D1
    assert daily.daily_report(b, day_by="event").first().report_date == dt.date(2023, 11, 14)


def test_sales_are_exact_decimals(spark):
    recs = [rec(f"u_{i}", "i_1", "buy", 0.1) for i in range(10)]
    r = daily.daily_report(behavior_df(spark, recs)).first()
    assert r.total_sales == 1.0 and r.top1_sales == 1.0
