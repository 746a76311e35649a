"""Facts: accumulating order snapshot (D13) and order lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion.functions import date_key, day_boundaries, hour_boundaries, surrogate_key
from medallion.functions.ranking import latest_struct


def order_status_summary(stg_orders_status_changed: DataFrame) -> DataFrame:
    """Latest status and first time in each status, per order.

    One ``groupBy(order_id)`` replaces the reference's four ROW_NUMBER windows
    and four self-joins; it aggregates map-side first, so an order with a
    huge number of changes does not concentrate rows in one reducer.
    """
    sc = stg_orders_status_changed
    first_in = lambda s: F.min(F.when(F.col("new_status") == s, F.col("changed_at")))
    latest = latest_struct(
        F.struct(F.col("new_status").alias("status"), F.col("changed_at").alias("at")),
        [F.col("changed_at"), F.col("event_id")],
    )
    return sc.groupBy("order_id").agg(
        latest.alias("_last"),
        first_in("paid").alias("paid_at"),
        first_in("shipped").alias("shipped_at"),
        first_in("delivered").alias("delivered_at"),
    )


def fct_orders(
    stg_orders_created: DataFrame, stg_orders_status_changed: DataFrame
) -> DataFrame:
    """One row per created order with its current state and SLAs (D13; J02)."""
    o = stg_orders_created
    s = order_status_summary(stg_orders_status_changed)
    j = o.join(s, "order_id", "left")
    current = F.col("_last.status")
    created = F.col("created_at")
    return j.select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id",
        surrogate_key("customer_id").alias("customer_sk"),
        date_key(created).alias("created_date_key"),
        date_key("paid_at").alias("paid_date_key"),
        date_key("shipped_at").alias("shipped_date_key"),
        date_key("delivered_at").alias("delivered_date_key"),
        F.coalesce(current, F.lit("created")).alias("current_status"),
        F.col("amount").alias("order_amount"),
        "currency",
        "item_count",
        created.alias("created_at"),
        "paid_at",
        "shipped_at",
        "delivered_at",
        F.col("_last.at").alias("last_status_changed_at"),
        day_boundaries(created, "paid_at").alias("days_to_paid"),
        day_boundaries(created, "shipped_at").alias("days_to_shipped"),
        day_boundaries(created, "delivered_at").alias("days_to_delivered"),
        F.col("delivered_at").isNotNull().alias("is_delivered"),
        F.coalesce(current.isin(*C.TERMINAL_STATUSES), F.lit(False)).alias("is_completed"),
    )


def fct_order_lifecycle(
    stg_orders_status_changed: DataFrame, stg_orders_created: DataFrame
) -> DataFrame:
    """One row per status change of a known order (D14; J03, F18, F19).

    Inner equi-join on ``order_id``: a sort-merge join whose skewed
    partitions (an order with very many changes) AQE splits at runtime.
    """
    sc = stg_orders_status_changed.alias("sc")
    o = stg_orders_created.select(
        "order_id",
        F.col("customer_id").alias("o_customer_id"),
        F.col("created_at").alias("o_created_at"),
        F.col("amount").alias("o_amount"),
        F.col("currency").alias("o_currency"),
        F.col("item_count").alias("o_item_count"),
    )
    j = sc.join(o, "order_id", "inner")
    return j.select(
        surrogate_key("event_id").alias("lifecycle_sk"),
        "event_id",
        "order_id",
        surrogate_key("order_id").alias("order_sk"),
        surrogate_key("o_customer_id").alias("customer_sk"),
        date_key("changed_at").alias("changed_date_key"),
        date_key("o_created_at").alias("created_date_key"),
        "old_status",
        "new_status",
        "changed_at",
        F.col("o_created_at").alias("order_created_at"),
        day_boundaries("o_created_at", "changed_at").alias("days_since_creation"),
        hour_boundaries("o_created_at", "changed_at").alias("hours_since_creation"),
        F.col("o_customer_id").alias("customer_id"),
        F.col("o_amount").alias("order_amount"),
        F.col("o_currency").alias("currency"),
        F.col("o_item_count").alias("item_count"),
    )
