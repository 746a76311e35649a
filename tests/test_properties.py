"""Order of arrival does not change Gold."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.operators import bronze
from medallion.plans.warehouse import Warehouse

from conftest import env, lines_df

STATUSES = ["paid", "shipped", "delivered", "canceled"]


def _events(n_orders, changes):
    rows = []
    for o in range(n_orders):
        rows.append(env(f"oc{o}", "order_created", f"2024-01-0{1 + o % 5}T10:00:00Z",
                        {"order_id": f"o{o}", "customer_id": f"c{o % 3}", "amount": 10.5 + o,
                         "currency": "BRL", "item_count": 1 + o % 4}))
    for i, (o, s, h) in enumerate(changes):
        o %= n_orders
        rows.append(env(f"sc{i}", "order_status_changed", f"2024-01-0{1 + o % 5}T{10 + h:02d}:30:00Z",
                        {"order_id": f"o{o}", "old_status": "created", "new_status": s}))
    for c in range(3):
        rows.append(env(f"cr{c}", "customer_registered", "2023-12-01T00:00:00Z",
                        {"customer_id": f"c{c}", "name": f"n{c}", "email": f"e{c}", "state": "SP"}))
    return rows


def _gold(spark, loads):
    b = None
    for i, rows in enumerate(loads):
        part = bronze.load(lines_df(spark, [(r, f"f{i}") for r in rows]), f"2026-01-01 0{i}:00:00")
        b = part if b is None else b.unionByName(part)
    w = Warehouse.from_bronze(spark, b)
    fo = sorted(tuple(r) for r in w.fct_orders.collect())
    fn = sorted(tuple(r) for r in w.mart_order_funnel.collect())
    return fo, fn


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    n_orders=st.integers(1, 6),
    changes=st.lists(st.tuples(st.integers(0, 10), st.sampled_from(STATUSES), st.integers(0, 9)),
                     max_size=12),
    seed=st.integers(0, 10_000),
)
def test_arrival_order_and_redelivery_do_not_change_gold(spark, n_orders, changes, seed):
    rows = _events(n_orders, changes)
    base = _gold(spark, [rows])
    rnd = random.Random(seed)
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    cut = rnd.randint(0, len(shuffled))
    redelivered = rnd.sample(shuffled, k=min(3, len(shuffled)))
    assert _gold(spark, [shuffled[:cut], shuffled[cut:] + redelivered]) == base
