import os

import pytest

from medallion import materialize
from medallion.plans.warehouse import Warehouse


def test_layer_routing():
    assert materialize.qualify("gold", "fct_orders", env="prod") == "prod_gold.fct_orders"
    assert materialize.qualify("gold", "x", custom_schema="MARTS") == "MARTS.x"
    with pytest.raises(ValueError):
        materialize.qualify("platinum", "x")


def test_table_view_and_audit(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    path = os.path.join(tmp, "t")
    materialize.write_table(df, path, audit=True)
    back = spark.read.parquet(path)
    assert back.columns == ["id", "v", "dbt_computed_at"]
    assert dict(back.dtypes)["dbt_computed_at"] == "timestamp_ntz"
    materialize.write_table(df.union(df), path)  # full replace
    assert spark.read.parquet(path).count() == 2
    materialize.as_view(df, "mat_view_t")
    assert spark.sql("SELECT count(*) AS n FROM mat_view_t").first().n == 1
    materialize.save_as_table(df, "mat_db_t.tbl", audit=True)
    assert spark.table("mat_db_t.tbl").count() == 1


def test_staging_views_registered(spark):
    from medallion.operators import silver
    from medallion.operators.bronze import load
    from conftest import env, lines_df

    b = load(lines_df(spark, [(env("e1", "order_created", "2026-05-02T12:00:10Z",
                                   {"order_id": "o1", "customer_id": "c1", "amount": 1,
                                    "currency": "BRL", "item_count": 1}), "f")]), "2026-01-01 00:00:00")
    w = Warehouse(spark, silver.build_all(b))
    names = w.register_views()
    assert spark.sql("SELECT order_id FROM stg_orders_created").first().order_id == "o1"
    assert len(names) == 4
    w.register_views(gold=True)
    r = spark.sql("SELECT status_name, orders_count FROM mart_order_funnel").first()
    assert (r.status_name, r.orders_count) == ("created", 1)


def test_partitioned_table_write_is_a_full_replace(spark, tmp):
    path = os.path.join(tmp, "p")
    materialize.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string"), path, partition_by=["k"])
    materialize.write_table(spark.createDataFrame([(3, "a")], "id int, k string"), path, partition_by=["k"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3]


def test_custom_schema_is_trimmed():
    from medallion.materialize import qualify

    assert qualify("gold", "t", custom_schema=" marts ") == "marts.t"
    assert qualify("gold", "t", custom_schema="  ") == "dev_gold.t"
