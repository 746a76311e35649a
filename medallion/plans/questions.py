"""Analytical questions the model is built to answer.

All are small group-bys over the Gold tables; none uses a window over a raw
key (an order or customer holding a third of the rows would then sit in one
task). Where a per-order sequence is needed (U03) it is expressed as an
aggregate plus an equi-join, which Spark combines map-side and AQE de-skews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion.functions import hour_boundaries
from medallion.functions.aggregates import mean, ratio
from medallion.functions.bitmaps import member_counts, rolled_up


def avg_days_to_delivery(fct_orders: DataFrame) -> DataFrame:
    """Mean day boundaries from creation to delivery (delivered orders)."""
    return fct_orders.agg(
        F.count("days_to_delivered").alias("delivered_orders"),
        mean("days_to_delivered").alias("avg_days_to_delivery"),
        F.min("days_to_delivered").alias("min_days_to_delivery"),
        F.max("days_to_delivered").alias("max_days_to_delivery"),
    )


def aov_by_state(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Average order value by the customer's current state."""
    c = dim_customers.select("customer_sk", F.col("state").alias("customer_state"))
    return (
        fct_orders.join(c, "customer_sk", "inner")
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            F.sum("order_amount").alias("revenue"),
            mean("order_amount").alias("avg_order_value"),
        )
    )


def transition_gaps(fct_order_lifecycle: DataFrame) -> DataFrame:
    """Hours between entering a status and leaving it, per transition.

    For each change ``old -> new`` the order entered ``old`` at the first
    change into ``old`` (or at creation when ``old`` is ``created``); the gap
    counts hour boundaries from that time to the change. Entry times are one
    aggregate on ``(order_id, status)``; the lookup is an equi-join on that
    pair, so no per-order window or pairwise join is needed.
    """
    lc = fct_order_lifecycle
    entered = lc.groupBy("order_id", F.col("new_status").alias("old_status")).agg(
        F.min("changed_at").alias("entered_at")
    )
    j = lc.join(entered, ["order_id", "old_status"], "left")
    since = F.when(F.col("old_status") == "created", F.col("order_created_at")).otherwise(
        F.col("entered_at")
    )
    gaps = j.select("old_status", "new_status", hour_boundaries(since, "changed_at").alias("gap_hours"))
    return gaps.groupBy("old_status", "new_status").agg(
        F.count(F.lit(1)).alias("transitions"),
        F.count("gap_hours").alias("timed_transitions"),
        mean("gap_hours").alias("avg_gap_hours"),
        F.min("gap_hours").alias("min_gap_hours"),
        F.max("gap_hours").alias("max_gap_hours"),
    )


def status_transitions(fct_order_lifecycle: DataFrame) -> DataFrame:
    """Conversion between statuses.

    ``share_of_exits`` is the transition's share of all changes leaving
    ``old_status``; the window runs over the grouped pairs (at most
    statuses², never raw rows).
    """
    g = fct_order_lifecycle.groupBy("old_status", "new_status").agg(
        F.count(F.lit(1)).alias("transitions"),
        F.count_distinct("order_id").alias("orders"),
    )
    exits = F.sum("transitions").over(Window.partitionBy("old_status"))
    return g.withColumn("share_of_exits", F.round(ratio(F.col("transitions"), exits), 4))


def changes_over_time(fct_order_lifecycle: DataFrame) -> DataFrame:
    """Status changes per month and new status.

    The month is that of the change's date key, so every change counts, also
    outside a calendar, and the fact meets no other table.
    """
    month = F.floor(F.col("changed_date_key") / 100).cast("int")
    g = (
        fct_order_lifecycle.where(F.col("changed_date_key").isNotNull())
        .groupBy(month.alias("month"), "new_status")
        .agg(F.count(F.lit(1)).alias("changes"), F.count_distinct("order_id").alias("orders"))
    )
    return g.select(F.regexp_replace(F.col("month").cast("string"), r"(\d\d)$", r"-$1").alias("year_month"), "new_status", "changes", "orders")


def revenue_seasonality(mart_daily_revenue: DataFrame) -> DataFrame:
    """Weekday seasonality per state, re-aggregated from the mart's sums
    (averages are recomputed from sums, never averaged)."""
    return mart_daily_revenue.groupBy("customer_state", "day_name_short", "is_weekend").agg(
        F.sum("orders_count").alias("orders_count"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("total_items_sold").alias("total_items_sold"),
        ratio(F.sum("gross_revenue"), F.sum("orders_count")).alias("avg_order_value"),
    )


def revenue_by_month(mart_daily_revenue: DataFrame) -> DataFrame:
    """U06 (month side): revenue per state and calendar month, from the
    mart's sums."""
    return mart_daily_revenue.groupBy("customer_state", "year_month").agg(
        F.sum("orders_count").alias("orders_count"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("completed_orders").alias("completed_orders"),
        ratio(F.sum("gross_revenue"), F.sum("orders_count")).alias("avg_order_value"),
    )


def unique_customers_by_month(mart_daily_customers: DataFrame) -> DataFrame:
    """U06 (customers): distinct ordering customers per state and month, from the
    daily bitmaps alone; sums of daily counts would count a customer once a day."""
    month = F.floor(F.col("created_date_key") / 100).cast("int")
    days = mart_daily_customers.where(F.col("created_date_key").isNotNull()).withColumn("month_key", month)
    months = rolled_up(days, ["customer_state", "month_key"])
    counts = member_counts(months, ["customer_state", "month_key"], "unique_customers")
    return counts.select("customer_state", F.regexp_replace(F.col("month_key").cast("string"), r"(\d\d)$", r"-$1").alias("year_month"), "unique_customers")


def revenue_by_status(mart_order_funnel: DataFrame) -> DataFrame:
    """Pending (non-terminal) orders and the revenue held in each status."""
    return mart_order_funnel.where(~F.col("status_name").isin(*C.TERMINAL_STATUSES)).select(
        "funnel_step", "status_name", "orders_count", "revenue_in_status"
    )
