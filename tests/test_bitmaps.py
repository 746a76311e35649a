from pyspark.sql import functions as F

from medallion.functions import bitmaps


def test_numbers_are_dense_and_follow_the_order(spark, tmp):
    keys = spark.createDataFrame([(f"c{i:04d}", "ABC"[i % 3]) for i in range(1000)] + [("none", None)], "customer string, state string").repartition(7)
    keys.write.parquet(tmp + "/keys")
    got = bitmaps.numbered(spark.read.parquet(tmp + "/keys"), "customer", ["state"]).orderBy("member_no").collect()
    assert [r.member_no for r in got] == list(range(1001))
    assert [(r.state or "", r.customer) for r in got] == sorted((r.state or "", r.customer) for r in got)
    assert bitmaps.numbered(keys.limit(0), "customer", ["state"]).collect() == []


def test_roll_ups_of_daily_bitmaps_are_exact_distinct_counts(spark):
    rows = [(d, s, m) for d in range(1, 40) for s in ("A", "B", None) for m in ((d * 7919 + k * 32_000) % 100_000 for k in range(30))]
    rows += [(1, "A", 5)] * 5000 + [(2, "A", None), (99, "C", None)]
    df = spark.createDataFrame(rows, "day int, state string, member_no long")
    daily = bitmaps.member_bitmaps(df, ["day", "state"])
    want = {(d, s): len({m for x, y, m in rows if (x, y) == (d, s) and m is not None}) for d, s, _ in rows}
    got = {(r.day, r.state): r.members for r in bitmaps.member_counts(daily, ["day", "state"]).collect()}
    assert got == {k: n for k, n in want.items() if n}
    months = bitmaps.rolled_up(daily.withColumn("month", (F.col("day") / 10).cast("int")), ["month", "state"])
    got = {(r.month, r.state): r.members for r in bitmaps.member_counts(months, ["month", "state"]).collect()}
    assert got == {k: len({m for d, y, m in rows if m is not None and (d // 10, y) == k}) for k in got} and len(got) == 12
    everyone = bitmaps.rolled_up(daily, [])
    assert bitmaps.member_counts(everyone, []).first().members == len({m for _, _, m in rows if m is not None})


def test_daily_revenue_has_no_expand(spark):
    from medallion.plans.marts import mart_daily_revenue

    orders = spark.createDataFrame(
        [("o1", "c1", 1, 2.0, 1, True, True), ("o1", "c2", 1, 3.0, 1, False, False), ("o2", "c1", 1, 4.0, 1, True, False), ("o3", "c3", None, 1.0, 1, True, True)],
        "order_id string, customer_sk string, created_date_key int, order_amount double, item_count int, is_completed boolean, is_delivered boolean")
    customers = spark.createDataFrame([("c1", "A"), ("c2", None), ("c2", None), ("c3", "A"), ("c1", "A")], "customer_sk string, state string")
    days = spark.createDataFrame([(1, None, "1995-01", "Sun", True)], "date_key int, full_date date, year_month string, day_name_short string, is_weekend boolean")
    mart = mart_daily_revenue(orders, customers, days, 1)
    assert {(r.customer_state, r.orders_count, r.unique_customers, r.gross_revenue) for r in mart.collect()} == {("A", 2, 1, 12.0), (None, 1, 1, 6.0)}
    assert "Expand" not in mart._jdf.queryExecution().executedPlan().toString()
