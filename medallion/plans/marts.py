"""Marts: daily revenue by customer state (D15) and order funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion.functions.aggregates import count_true, mean, ratio
from medallion.functions.bitmaps import member_bitmaps

# A calendar is broadcast by hint only when its day count is known to be at
# most this (a century of days is ~36.5k rows, a few MB).
BROADCAST_CALENDAR_DAYS = 100_000


def mart_daily_revenue(
    fct_orders: DataFrame,
    dim_customers: DataFrame,
    dim_date: DataFrame,
    calendar_days: int | None = None,
) -> DataFrame:
    """Revenue per (day, customer state) (D15; J04, J05, A02-A07, A09).

    Plan: orders ⋈ customers on ``customer_sk`` (shuffle join; AQE splits a
    customer holding a large share of orders), then the grouped aggregate on
    ``(created_date_key, customer_state)`` with map-side partial aggregation.
    The distinct customers are an aggregate of their own, as two distinct counts in one
    would expand every order into three rows; both meet as aggregated rows.
    Then come the calendar attributes, joined to the *aggregated* rows too. Joining
    the calendar after grouping is exact because ``date_key`` is unique in the
    calendar, and keeps the six grouping columns out of the big shuffle.
    The calendar is broadcast when its size is known (``calendar_days``);
    otherwise AQE decides from its measured size.
    """
    o = fct_orders.select(
        "order_id", "customer_sk", "created_date_key", "order_amount",
        "item_count", "is_completed", "is_delivered",
    )
    c = dim_customers.select("customer_sk", F.col("state").alias("customer_state"))
    enriched = o.join(c, "customer_sk", "inner")
    n = F.count(F.lit(1))
    agg = enriched.groupBy("created_date_key", "customer_state").agg(
        F.count_distinct("order_id").alias("orders_count"),
        F.sum("order_amount").alias("gross_revenue"),
        mean("order_amount").alias("avg_order_value"),
        F.min("order_amount").alias("min_order_value"),
        F.max("order_amount").alias("max_order_value"),
        F.sum("item_count").cast("bigint").alias("total_items_sold"),
        mean("item_count").alias("avg_items_per_order"),
        count_true("is_completed").alias("completed_orders"),
        count_true("is_delivered").alias("delivered_orders"),
        ratio(count_true("is_completed"), n).alias("completion_rate"),
        ratio(count_true("is_delivered"), n).alias("delivery_rate"),
    )
    # a day's customers once each before they meet their states: two columns of the fact
    pairs = fct_orders.select("created_date_key", "customer_sk").distinct().join(c, "customer_sk", "inner")
    unique = pairs.groupBy(F.col("created_date_key").alias("_day"), F.col("customer_state").alias("_state")).agg(
        F.count_distinct("customer_sk").alias("unique_customers")
    )
    same = (F.col("created_date_key").eqNullSafe(F.col("_day"))) & (F.col("customer_state").eqNullSafe(F.col("_state")))
    agg = agg.join(unique, same, "inner")
    d = dim_date.select(
        F.col("date_key").alias("day_date_key"),
        F.col("full_date").alias("day_date"),
        "year_month",
        "day_name_short",
        "is_weekend",
    )
    if calendar_days is not None and calendar_days <= BROADCAST_CALENDAR_DAYS:
        d = F.broadcast(d)
    j = agg.join(d, agg.created_date_key == d.day_date_key, "inner")
    return j.select(
        "day_date_key", "day_date", "year_month", "day_name_short", "is_weekend",
        "customer_state", "orders_count", "unique_customers", "gross_revenue",
        "avg_order_value", "min_order_value", "max_order_value", "total_items_sold",
        "avg_items_per_order", "completed_orders", "delivered_orders",
        "completion_rate", "delivery_rate",
    )


def funnel_step(status):
    step = F.lit(C.UNKNOWN_FUNNEL_STEP)
    for name, n in sorted(C.FUNNEL_STEPS.items(), key=lambda kv: -kv[1]):
        step = F.when(status == name, F.lit(n)).otherwise(step)
    return step.cast("int")


def mart_order_funnel(fct_orders: DataFrame) -> DataFrame:
    """Orders and revenue per current status (D16; A01, A03, A04, A08, P11, O01).

    The total for ``pct_of_total`` (the sum of the per-status counts, i.e.
    the fact's row count) is a scalar subquery: one value computed by Spark
    and inlined, so there is no join of any kind. It is written as a row
    count of ``fct_orders`` because Catalyst then drops the fact's outer join
    (its right side is unique on the key) and counts a column-less scan,
    instead of re-deriving every order's status.
    """
    counts = fct_orders.groupBy("current_status").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("order_amount").alias("revenue_in_status"),
        mean("order_amount").alias("avg_amount"),
    )
    total = fct_orders.select(F.count(F.lit(1))).scalar()
    return counts.select(
        funnel_step(F.col("current_status")).alias("funnel_step"),
        F.col("current_status").alias("status_name"),
        "orders_count",
        "revenue_in_status",
        F.round("avg_amount", 2).alias("avg_amount"),
        F.round(ratio(F.col("orders_count"), total), 4).alias("pct_of_total"),
    ).orderBy("funnel_step", "status_name")


def mart_daily_customers(fct_orders: DataFrame, numbered_customers: DataFrame) -> DataFrame:
    """Bitmaps of the customers that ordered, per (day, customer state).

    ``numbered_customers``: customer_sk, customer_state, member_no (``functions.bitmaps.numbered``,
    by state, so that a day and state touch few ranges). The rows roll up exactly over any
    days and states.
    """
    o = fct_orders.select("created_date_key", "customer_sk").distinct()
    return member_bitmaps(o.join(numbered_customers, "customer_sk", "inner"), ["created_date_key", "customer_state"])
