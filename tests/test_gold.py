import datetime as dt

from pyspark.sql import functions as F

from medallion.operators import quality
from medallion.plans import dimensions, facts, marts

T = dt.datetime.fromisoformat

OC = "event_id string, order_id string, customer_id string, created_at timestamp_ntz, amount decimal(10,2), currency string, item_count int, ingested_at timestamp_ntz"
SC = "event_id string, order_id string, changed_at timestamp_ntz, old_status string, new_status string, ingested_at timestamp_ntz"
CR = "event_id string, customer_id string, registered_at timestamp_ntz, customer_name string, email string, state string, ingested_at timestamp_ntz"
CU = "event_id string, customer_id string, updated_at timestamp_ntz, field_changed string, old_value string, new_value string, ingested_at timestamp_ntz"


def orders(spark):
    from decimal import Decimal as D
    oc = spark.createDataFrame([
        ("oc1", "o1", "c1", T("2024-01-01 10:00:00"), D("100.00"), "BRL", 1, None),
        ("oc2", "o2", "c1", T("2024-01-01 23:59:00"), D("50.00"), "BRL", 2, None),
        ("oc3", "o3", "c2", T("2024-01-02 08:00:00"), D("30.00"), "BRL", 3, None),
        ("oc4", "o4", "cX", T("2024-01-02 08:00:00"), D("70.00"), "BRL", 4, None),  # unregistered
        ("oc5", "o5", "c2", T("2031-01-02 08:00:00"), D("80.00"), "BRL", 5, None),  # outside calendar
        ("oc6", "o6", "c2", T("2024-01-03 08:00:00"), D("90.00"), "BRL", 6, None),
    ], OC)
    sc = spark.createDataFrame([
        # o1: jump created -> delivered
        ("s1", "o1", T("2024-01-03 10:00:00"), "created", "delivered", None),
        # o2: two paid rows, first wins; then canceled
        ("s2", "o2", T("2024-01-02 00:01:00"), "created", "paid", None),
        ("s3", "o2", T("2024-01-02 05:00:00"), "created", "paid", None),
        ("s4", "o2", T("2024-01-04 00:00:00"), "paid", "canceled", None),
        # unknown order
        ("s5", "oZ", T("2024-01-04 00:00:00"), "created", "paid", None),
        # unknown status
        ("s6", "o6", T("2024-01-04 00:00:00"), "created", "lost", None),
    ], SC)
    return oc, sc


def customers(spark):
    cr = spark.createDataFrame([
        ("r1", "c1", T("2023-12-01 00:00:00"), "Ana", "a@x", "SP", None),
        ("r2", "c2", T("2023-12-01 00:00:00"), "Bia", "b@x", "RJ", None),
    ], CR)
    cu = spark.createDataFrame([
        ("u1", "c1", T("2024-01-05 00:00:00"), "email", "a@x", "a1@x", None),
        ("u2", "c1", T("2024-01-05 00:00:00"), "email", "a@x", "a2@x", None),  # tie: higher event_id
        ("u3", "c2", T("2024-01-06 00:00:00"), "state", "RJ", None, None),     # latest NULL value
        ("u4", "c2", T("2024-01-01 00:00:00"), "state", "RJ", "MG", None),
        ("u5", "cZ", T("2024-01-01 00:00:00"), "state", "RJ", "MG", None),     # unregistered
    ], CU)
    return cr, cu


def test_fct_orders_cases(spark):
    oc, sc = orders(spark)
    f = {r.order_id: r for r in facts.fct_orders(oc, sc).collect()}
    assert f["o3"].current_status == "created" and f["o3"].is_completed is False
    assert f["o1"].current_status == "delivered" and f["o1"].paid_at is None and f["o1"].shipped_at is None
    assert f["o1"].is_delivered and f["o1"].days_to_delivered == 2
    assert f["o2"].paid_at == T("2024-01-02 00:01:00") and f["o2"].days_to_paid == 1
    assert f["o2"].is_completed is True and f["o2"].is_delivered is False
    assert f["o2"].paid_date_key == 20240102 and f["o2"].last_status_changed_at == T("2024-01-04 00:00:00")


def test_lifecycle_drops_orphans_and_counts_boundaries(spark):
    oc, sc = orders(spark)
    lc = {r.event_id: r for r in facts.fct_order_lifecycle(sc, oc).collect()}
    assert "s5" not in lc and len(lc) == 5
    assert lc["s2"].days_since_creation == 1 and lc["s2"].hours_since_creation == 1


def test_dim_customers_cases(spark):
    cr, cu = customers(spark)
    d = {r.customer_id: r for r in dimensions.dim_customers(cr, cu).collect()}
    assert set(d) == {"c1", "c2"}
    assert d["c1"].email == "a2@x" and d["c1"].has_been_updated
    assert d["c2"].state == "RJ" and d["c2"].last_updated_at == T("2024-01-06 00:00:00")


def test_daily_revenue_and_funnel(spark):
    oc, sc = orders(spark)
    cr, cu = customers(spark)
    fo = facts.fct_orders(oc, sc)
    dc = dimensions.dim_customers(cr, cu)
    dd = dimensions.dim_date(spark)
    rev = marts.mart_daily_revenue(fo, dc, dd, 1461).collect()
    assert sum(r.orders_count for r in rev) == 4  # o4 (unknown customer), o5 (2031) drop
    day1 = [r for r in rev if r.day_date_key == 20240101][0]
    assert day1.orders_count == 2 and day1.unique_customers == 1 and str(day1.gross_revenue) == "150.00"
    assert day1.completion_rate == 1.0 and day1.delivery_rate == 0.5
    fun = marts.mart_order_funnel(fo).collect()
    steps = {r.status_name: r.funnel_step for r in fun}
    assert steps["lost"] == 99 and steps["created"] == 1
    assert abs(sum(r.pct_of_total for r in fun) - 1.0) < 1e-3  # rounded to 4 places
    rep = quality.run({"mart_order_funnel": marts.mart_order_funnel(fo)},
                      [c for c in quality.SUITE if c.relation == "mart_order_funnel"])
    bad = {(r.column_name, r.test): r.failures for r in quality.failing(rep).collect()}
    assert bad == {("status_name", "accepted_values"): 1}


def test_dim_date_default_range(spark):
    d = dimensions.dim_date(spark)
    assert d.count() == 1461
    r = d.where(F.col("full_date") == F.lit("2024-12-30").cast("date")).collect()[0]
    assert r.week_of_year == 1 and r.year_quarter == "2024-4" and r.quarter_start_date == dt.date(2024, 10, 1)


def test_hot_order_is_aggregated_map_side(spark):
    """An order holding a third of all changes: the per-order aggregate is
    partial (map-side) before its exchange, and the lifecycle join is a
    plain equi-join AQE can split."""
    from decimal import Decimal as D

    oc = spark.createDataFrame(
        [(f"oc{i}", f"o{i}", "c1", T("2024-01-01 10:00:00"), D("1.00"), "BRL", 1, None) for i in range(20)], OC)
    hot = [(f"h{i}", "o0", T("2024-01-02 00:00:00"), "created", "paid", None) for i in range(40)]
    rest = [(f"s{i}", f"o{i}", T("2024-01-03 00:00:00"), "paid", "shipped", None) for i in range(1, 20)]
    sc = spark.createDataFrame(hot + rest, SC)
    fo = facts.fct_orders(oc, sc)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fo._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "partial_max_by" in plan and "partial_min" in plan
    r = {x.order_id: x for x in fo.collect()}
    assert r["o0"].current_status == "paid" and r["o0"].paid_at == T("2024-01-02 00:00:00")
    lc = facts.fct_order_lifecycle(sc, oc)
    assert lc.where("order_id = 'o0'").count() == 40


def test_null_registration_time_gives_null_last_update(spark):
    cr = spark.createDataFrame([("r1", "c1", None, "Ana", "a@x", "SP", None)], CR)
    cu = spark.createDataFrame([("u1", "c1", T("2024-01-05 00:00:00"), "email", "a@x", "b@x", None)], CU)
    r = dimensions.dim_customers(cr, cu).collect()[0]
    assert r.last_updated_at is None and r.email == "b@x" and r.has_been_updated


def test_stored_silver_is_read_pruned(spark):
    import __spark_entry__ as E

    w = E._warehouse(spark, "/root/testdata/sf0.001")
    scan = w.model("mart_order_funnel")._jdf.queryExecution().executedPlan().toString()
    assert set(w.silver) == {"orders_created", "orders_status_changed"}  # only what the model needs is built
    assert "FileScan parquet" in scan and "_source_file" not in scan and "Scan ExistingRDD" not in scan
