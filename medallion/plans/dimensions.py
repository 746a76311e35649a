"""Dimensions: customers (D10), calendar (D11), products."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion.functions import (
    date_key,
    day_of_week_sunday0,
    padded_name,
    strict_greatest,
    surrogate_key,
)
from medallion.functions.ranking import latest_struct
from medallion.sources.seed import dim_products  # noqa: F401  (re-export, D12)


def customer_changes(stg_customers_updated: DataFrame) -> DataFrame:
    """Latest email and state change per customer in ONE aggregate.

    The reference computes two ROW_NUMBER windows and joins both back; here
    both "latest" values come from a single ``groupBy(customer_id)`` with
    filtered ``max_by`` (ties on ``updated_at`` broken by ``event_id``).
    """
    u = stg_customers_updated
    order = [F.col("updated_at"), F.col("event_id")]
    is_email = F.col("field_changed") == "email"
    is_state = F.col("field_changed") == "state"
    latest_email = latest_struct(F.struct(F.col("new_value").alias("v"), F.col("updated_at").alias("at")), order, is_email)
    latest_state = latest_struct(F.struct(F.col("new_value").alias("v"), F.col("updated_at").alias("at")), order, is_state)
    return (
        u.where(F.col("field_changed").isin(*C.UPDATABLE_FIELDS))
        .groupBy("customer_id")
        .agg(latest_email.alias("le"), latest_state.alias("ls"))
    )


def dim_customers(
    stg_customers_registered: DataFrame, stg_customers_updated: DataFrame
) -> DataFrame:
    """SCD1 current state per registered customer (D10; J01, F02, F03)."""
    r = stg_customers_registered
    ch = customer_changes(stg_customers_updated)
    j = r.join(ch, "customer_id", "left")
    reg = F.col("registered_at")
    return j.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id",
        "customer_name",
        F.coalesce(F.col("le.v"), F.col("email")).alias("email"),
        F.coalesce(F.col("ls.v"), F.col("state")).alias("state"),
        reg.alias("registered_at"),
        strict_greatest(
            reg,
            F.coalesce(F.col("le.at"), reg),
            F.coalesce(F.col("ls.at"), reg),
        ).alias("last_updated_at"),
        (F.col("le").isNotNull() | F.col("ls").isNotNull()).alias("has_been_updated"),
    )


def _as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def dim_date(
    spark: SparkSession,
    start: str | dt.date = C.CALENDAR_START,
    end: str | dt.date = C.CALENDAR_END,
) -> DataFrame:
    """Calendar, one row per day in ``[start, end]`` (D11; S09, F07-F17).

    ``spark.range`` is partitioned and gap-free; its size is fixed by the
    range, never by data, which is what makes broadcasting it safe.
    """
    s, e = _as_date(start), _as_date(end)
    n = (e - s).days + 1
    days = spark.range(0, max(n, 0), numPartitions=max(1, min(8, n // 512 + 1)))
    return calendar(days.select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("full_date")))


def calendar(spine: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one ``full_date`` column."""
    d = F.col("full_date")
    dow = day_of_week_sunday0(d)
    weekend = dow.isin(0, 6)
    return spine.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        F.when(F.month(d) <= 6, 1).otherwise(2).alias("semester"),
        dow.alias("day_of_week_number"),
        padded_name(d, "EEEE").alias("day_name_full"),
        F.date_format(d, "EEE").alias("day_name_short"),
        padded_name(d, "MMMM").alias("month_name_full"),
        F.date_format(d, "MMM").alias("month_name_short"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (F.dayofmonth(d) == 1).alias("is_first_day_of_month"),
        (d == F.last_day(d)).alias("is_last_day_of_month"),
        F.trunc(d, "MM").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(d, "QUARTER").alias("quarter_start_date"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "yyyy-Q").alias("year_quarter"),
    )


def calendar_spanning(df: DataFrame, *ts_cols: str) -> DataFrame:
    """Calendar covering the first to the last day found in ``ts_cols``.

    The bounds are one global aggregate (partial per partition); the day
    spine is ``sequence`` + ``explode`` of that single row, so its size is the
    number of days in the span, not the number of input rows.
    """
    mins = [F.min(F.col(c)) for c in ts_cols]
    maxs = [F.max(F.col(c)) for c in ts_cols]
    lo = (F.least(*mins) if len(mins) > 1 else mins[0]).cast("date")
    hi = (F.greatest(*maxs) if len(maxs) > 1 else maxs[0]).cast("date")
    bounds = df.agg(lo.alias("lo"), hi.alias("hi"))
    spine = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    return calendar(spine)
