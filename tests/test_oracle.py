"""Registered queries against their DuckDB oracle at sf0.001.

The full comparison of every query at sf0.01 is ``tools/check_oracle.py``.
"""

import decimal

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
NAMES = ["bronze_reject_gate", "silver_customers_updated", "dim_customers", "fct_orders",
         "fct_order_lifecycle", "mart_daily_revenue", "mart_order_funnel", "dq_not_null",
         "transition_gaps", "changes_over_time", "dq_violations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return str(v) if isinstance(v, decimal.Decimal) else repr(v)

    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _key(got, df.columns) == _key(want, cols)
