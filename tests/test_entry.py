import re

import __spark_entry__ as E


def test_entry_runs_on_smallest_tables(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "gross_revenue" in df.columns


def test_every_query_has_an_oracle():
    # the training-data operators, there or not, have SQL only where SQL can express them
    own = {q for q in E.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert own == {q for q in E.oracle_sql() if not re.match(r"op\d+_", q)}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_flagship_matches_fixture_expectations(spark):
    f = {r.status_name: r for r in E.queries()["mart_order_funnel"](spark, "/root/testdata/sf0.01").collect()}
    assert {k: v.orders_count for k, v in f.items()} == {
        "created": 1500, "paid": 3966, "shipped": 4057, "delivered": 3977, "canceled": 1500}
    assert str(f["paid"].revenue_in_status) == "1003483785.21"


def test_every_query_documents_what_it_runs():
    for name, fn in E.queries().items():
        assert fn.__doc__ and fn.__doc__.strip(), name


def test_warehouse_use_rejects_unknown_models(spark):
    import pytest

    from medallion.plans.warehouse import Warehouse

    w = Warehouse(spark, {})
    with pytest.raises(KeyError):
        w.use("not_a_model", spark.range(1))
