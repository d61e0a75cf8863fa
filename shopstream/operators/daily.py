"""Daily batch metrics: sales, top products, funnel, category sales, report.

Every function works on any number of days at once: rows are keyed by
``report_date`` and one pass produces one result per day. ``day_by`` picks the
day of a row:

``event``    UTC calendar day of the event time (rows without one are skipped)
``arrival``  the ``dt`` column of a landing or warehouse read (the day the
             message arrived), which is what the original daily job used
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.money import MONEY, money_out, to_money
from shopstream.functions.timefns import event_time, utc_day
from shopstream.schema import BUY, CART, CLICK

TOP_K = 10          # products ranked per day
REPORT_TOP = 3      # products stored in the daily report


def with_report_date(behavior: DataFrame, day_by: str = "event") -> DataFrame:
    if "report_date" in behavior.columns:
        return behavior
    if day_by == "event":
        et = F.col("event_time") if "event_time" in behavior.columns else event_time("timestamp")
        return behavior.withColumn("report_date", utc_day(et)).where(
            F.col("report_date").isNotNull()
        )
    if day_by == "arrival":
        return behavior.withColumn("report_date", F.col("dt").cast("date")).where(
            F.col("report_date").isNotNull()
        )
    raise ValueError(f"day_by must be 'event' or 'arrival', not {day_by!r}")


# Kinds of the rows of ``daily_facts``.
ITEM, CATEGORY, USER = "item", "category", "user"


def _is_buy() -> Column:
    return F.col("behavior_type") == F.lit(BUY)


def _buy_amount() -> Column:
    return F.when(_is_buy(), to_money("amount"))


def total_sales(behavior: DataFrame, day_by: str = "event") -> DataFrame:
    """``report_date, total_sales``: buy amounts per day, 0.0 for a day without buys."""
    days = with_report_date(behavior, day_by)
    return days.groupBy("report_date").agg(
        money_out(F.coalesce(F.sum(_buy_amount()), F.lit(0))).alias("total_sales")
    )


def item_sales(behavior: DataFrame, day_by: str = "event") -> DataFrame:
    """``report_date, item_id, sales`` over buy rows."""
    days = with_report_date(behavior, day_by)
    return (
        days.where(_is_buy())
        .groupBy("report_date", "item_id")
        .agg(F.sum(to_money("amount")).alias("sales"))
    )


def _rank_by_sales(key: str) -> Column:
    # Ties go to the lower id so the ranking is deterministic.
    order = Window.partitionBy("report_date").orderBy(F.col("sales").desc(), F.col(key).asc())
    return F.row_number().over(order)


def top_products(behavior: DataFrame, k: int = TOP_K, day_by: str = "event") -> DataFrame:
    """``report_date, rank, item_id, sales``: the k best-selling items per day.

    The rank filter runs as a partial top-k before the shuffle by day, so each
    day's final task receives at most k rows per upstream task.
    """
    return best_items(item_sales(behavior, day_by), k)


def best_items(items: DataFrame, k: int = TOP_K) -> DataFrame:
    """``report_date, rank, item_id, sales`` of the k best rows a day of ``item_sales``."""
    ranked = items.withColumn("rank", _rank_by_sales("item_id"))
    return ranked.where(F.col("rank") <= k).select(
        "report_date", F.col("rank").cast("int").alias("rank"), "item_id",
        money_out("sales").alias("sales"),
    )


def behavior_funnel(behavior: DataFrame, day_by: str = "event") -> DataFrame:
    """``report_date, behavior_type, uv``: distinct users per day and type.

    Every type is kept, including ones the report ignores. The types are
    independent counts, not ordered funnel steps.
    """
    days = with_report_date(behavior, day_by)
    return days.groupBy("report_date", "behavior_type").agg(
        F.count_distinct("user_id").alias("uv")
    )


def category_sales(behavior: DataFrame, day_by: str = "event", sort: bool = True) -> DataFrame:
    """``report_date, category_id, sales`` over buy rows, best category first."""
    days = with_report_date(behavior, day_by)
    out = (
        days.where(_is_buy())
        .groupBy("report_date", "category_id")
        .agg(money_out(F.sum(to_money("amount"))).alias("sales"))
    )
    if sort:
        out = out.orderBy("report_date", F.col("sales").desc(), "category_id")
    return out


def daily_report(behavior: DataFrame, day_by: str = "event") -> DataFrame:
    """One ``daily_reports`` row per day present in the input.

    Two aggregates read the input: distinct (day, type, user) for the users per
    type, and (day, item) sales over buy rows (the buy filter reaches the scan
    of a warehouse table). Both are map-side combined, so a hot user or item
    costs one row per task. Everything after those exchanges is per-day sized:
    totals, top 3 and the user counts are combined by a union and one aggregate
    keyed by day instead of joins, so nothing is broadcast and no side needs a
    size check. Item sales feed both totals and the top 3; Spark reuses that
    exchange rather than computing it twice.
    """
    days = with_report_date(behavior, day_by)
    users = days.select(
        "report_date",
        F.when(_is_stored(), F.col("behavior_type")).alias("behavior_type"),
        F.when(_is_stored(), F.col("user_id")).alias("user_id"),
    ).distinct()
    return _report(users, item_sales(days))


def _is_stored() -> Column:
    # Only the three stored types are counted. Rows of other types keep just
    # their day (type and user nulled), so they collapse to one row per day
    # and task before the distinct shuffle while every day stays present.
    return F.col("behavior_type").isin(CLICK, CART, BUY)


def daily_facts(behavior: DataFrame, day_by: str = "event") -> DataFrame:
    """Everything the daily results are made of, in one scan and one shuffle.

    ``report_date, kind, key, user_id, sales``: a row for each (day, item) and (day, category) with
    the sales of its buys, and for each (day, stored type, user); a day with none of these has a row
    without type and user. A buy row takes part in three groups, others in one, and all are combined
    before the shuffle, so a hot item, category or user costs one row per task.
    """
    days = with_report_date(behavior, day_by)

    def fact(kind: str, key: Column, user: Column, amount: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), user.alias("user_id"), amount.alias("amount"))

    nothing, money = F.lit(None).cast("string"), to_money("amount")
    user = fact(USER, F.when(_is_stored(), F.col("behavior_type")), F.when(_is_stored(), F.col("user_id")),
                F.lit(None).cast(MONEY))
    facts = F.when(_is_buy(), F.array(fact(ITEM, F.col("item_id"), nothing, money),
                                      fact(CATEGORY, F.col("category_id"), nothing, money), user)).otherwise(F.array(user))
    return days.select("report_date", F.explode(facts).alias("fact")).select("report_date", "fact.*") \
        .groupBy("report_date", "kind", "key", "user_id").agg(F.sum("amount").alias("sales"))


def _sales_of(facts: DataFrame, kind: str, name: str) -> DataFrame:
    return facts.where(F.col("kind") == kind).select("report_date", F.col("key").alias(name), "sales")


def report_of(facts: DataFrame) -> DataFrame:
    """``daily_report`` from ``daily_facts``."""
    users = facts.where(F.col("kind") == USER).select("report_date", F.col("key").alias("behavior_type"), "user_id")
    return _report(users, _sales_of(facts, ITEM, "item_id"))


def top_products_of(facts: DataFrame, k: int = TOP_K) -> DataFrame:
    """``top_products`` from ``daily_facts``."""
    return best_items(_sales_of(facts, ITEM, "item_id"), k)


def category_sales_of(facts: DataFrame) -> DataFrame:
    """``category_sales`` from ``daily_facts``, in no order."""
    return _sales_of(facts, CATEGORY, "category_id").withColumn("sales", money_out("sales"))


def _report(users: DataFrame, items: DataFrame) -> DataFrame:
    """Report rows from distinct (report_date, behavior_type, user_id) and from item sales."""
    has_user = F.col("user_id").isNotNull()

    def uv(kind: str) -> Column:
        return F.count_if(has_user & (F.col("behavior_type") == F.lit(kind)))

    user_counts = users.groupBy("report_date").agg(
        uv(CLICK).alias("click_uv"), uv(CART).alias("cart_uv"), uv(BUY).alias("buy_uv"))
    totals = items.groupBy("report_date").agg(F.sum("sales").alias("total_sales"))
    ranked = items.withColumn("rank", _rank_by_sales("item_id")).where(
        F.col("rank") <= REPORT_TOP
    )
    top = ranked.groupBy("report_date").agg(
        F.max("rank").alias("top_n"),
        *[
            expr
            for i in range(1, REPORT_TOP + 1)
            for expr in (
                F.max(F.when(F.col("rank") == i, F.col("item_id"))).alias(f"top{i}_product"),
                F.max(F.when(F.col("rank") == i, F.col("sales"))).alias(f"top{i}_sales"),
            )
        ],
    )

    parts = user_counts.unionByName(totals, allowMissingColumns=True).unionByName(
        top, allowMissingColumns=True
    )
    merged = parts.groupBy("report_date").agg(
        *[F.max(c).alias(c) for c in parts.columns if c != "report_date"]
    )
    # A day with fewer than three products pads with "" and 0.0; no buys -> 0.0.
    cols = [F.col("report_date"), money_out(F.coalesce("total_sales", F.lit(0))).alias("total_sales")]
    for i in range(1, REPORT_TOP + 1):
        present = F.coalesce(F.col("top_n"), F.lit(0)) >= F.lit(i)
        cols.append(
            F.when(present, F.col(f"top{i}_product")).otherwise(F.lit("")).alias(f"top{i}_product")
        )
        cols.append(money_out(F.coalesce(f"top{i}_sales", F.lit(0))).alias(f"top{i}_sales"))
    cols += [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("click_uv", "cart_uv", "buy_uv")]
    return merged.select(*cols)
