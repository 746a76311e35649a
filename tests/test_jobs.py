import os

from medallion import jobs, materialize
from medallion.sources import fixtures


def test_load_refresh_build_from_files(spark, tmp):
    first, again = fixtures.deliveries(spark, "/root/testdata/sf0.001")
    landing = os.path.join(tmp, "landing")
    fixtures.write_landing(first, os.path.join(landing, "d0"))
    fixtures.write_landing(again, os.path.join(landing, "d1"))
    bpath, sroot, groot = (os.path.join(tmp, x) for x in ("bronze", "silver", "gold"))
    jobs.load(spark, os.path.join(landing, "d0"), bpath, "l0")
    jobs.load(spark, os.path.join(landing, "d1"), bpath, "l1")
    jobs.refresh_silver(spark, bpath, sroot)
    report = jobs.build(spark, sroot, groot, calendar=("1995-01-01", "2000-12-31"))
    rows = {(r.relation, r.column_name, r.test): r.failures for r in report.collect()}
    assert len(rows) == 117
    # silver is exactly-once by event id, the fixture has one registration per customer
    assert rows[("dt_orders_created", "event_id", "unique")] == 0
    assert rows[("dim_customers", "customer_id", "unique")] == 0
    # orders of 2001 are outside the 1995-2000 calendar
    assert rows[("fct_orders", "created_date_key", "relationships")] > 0
    assert "dbt_computed_at" in materialize.read_gold(spark, groot, "fct_orders").columns
    assert materialize.read_gold(spark, groot, "dim_products").count() == 20
    assert rows[("dim_products", "category", "accepted_values")] == 0


def test_bucketed_silver_gives_exchange_free_facts(spark, tmp):
    from medallion.plans.warehouse import Warehouse

    first, _ = fixtures.deliveries(spark, "/root/testdata/sf0.001")
    fixtures.write_landing(first, os.path.join(tmp, "l0"))
    jobs.load(spark, os.path.join(tmp, "l0"), os.path.join(tmp, "bronze"), "l0")
    jobs.refresh_silver_bucketed(spark, os.path.join(tmp, "bronze"), "silver_bucketed_t", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse.from_catalog(spark, "silver_bucketed_t")
        for name in ("fct_orders", "fct_order_lifecycle", "dim_customers"):
            plan = w.model(name)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, name
        assert w.fct_orders.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cli_load_refresh_build(spark, tmp, capsys):
    from medallion.__main__ import main

    first, _ = fixtures.deliveries(spark, "/root/testdata/sf0.001")
    fixtures.write_landing(first, os.path.join(tmp, "l"))
    b, s, g = (os.path.join(tmp, x) for x in ("b", "s", "g"))
    assert main(["load", "--landing", os.path.join(tmp, "l"), "--bronze", b, "--load-id", "x"]) == 0
    assert main(["refresh", "--bronze", b, "--silver", s]) == 0
    assert main(["build", "--silver", s, "--gold", g, "--calendar-start", "1990-01-01",
                 "--calendar-end", "2005-12-31"]) == 0
    out = capsys.readouterr().out
    assert "failing tests" in out


def test_compact_bronze_keeps_silver_identical(spark, tmp):
    from medallion.operators import bronze, silver
    from conftest import env, lines_df

    bpath = os.path.join(tmp, "bronze")
    for i in range(4):
        rows = [(env(f"e{i}{k}", "order_created", "2026-05-02T12:00:10Z",
                     {"order_id": f"o{k}", "customer_id": "c", "amount": 1, "currency": "BRL",
                      "item_count": 1}), f"f{i}") for k in range(3)]
        rows.append((env("dup", "order_created", "2026-05-02T12:00:10Z",
                         {"order_id": "o", "customer_id": "c", "amount": 1, "currency": "BRL",
                          "item_count": 1}), f"f{i}"))
        bronze.write_load(bronze.load(lines_df(spark, rows), f"2026-01-0{i + 1} 00:00:00"), bpath, f"s{i:012d}")
    before = sorted(tuple(r) for r in silver.build(bronze.read(spark, bpath), "orders_created").collect())
    n_before = bronze.read(spark, bpath).count()
    assert jobs.compact_bronze(spark, bpath, "c20260105", keep_recent=1) == [f"s{i:012d}" for i in range(3)]
    assert jobs.bronze_loads(spark, bpath) == ["c20260105", "s000000000003"]
    assert bronze.read(spark, bpath).count() == n_before
    after = sorted(tuple(r) for r in silver.build(bronze.read(spark, bpath), "orders_created").collect())
    assert after == before


def test_cli_stream_available_now(spark, tmp):
    from medallion.__main__ import main
    from medallion.streaming.silver_stream import read_silver
    from conftest import env, lines_df

    rows = [(env(f"e{k}", "customer_registered", "2026-05-02T12:00:10Z",
                 {"customer_id": f"c{k}", "name": "n", "email": "e", "state": "SP"}), "events/a.ndjson")
            for k in range(3)]
    fixtures.write_landing(lines_df(spark, rows), os.path.join(tmp, "landing"))
    args = ["stream", "--landing", os.path.join(tmp, "landing"), "--bronze", os.path.join(tmp, "b"),
            "--silver", os.path.join(tmp, "s"), "--checkpoint", os.path.join(tmp, "ck"), "--available-now"]
    assert main(args) == 0
    assert read_silver(spark, os.path.join(tmp, "s"), "customers_registered").count() == 3


def _orders(spark, ids, file="f", amount=1):
    from conftest import env, lines_df

    return lines_df(spark, [(env(i, "order_created", "2026-05-02T12:00:10Z",
                                 {"order_id": f"o-{i}", "customer_id": "c", "amount": amount, "currency": "BRL",
                                  "item_count": 1}), file) for i in ids])


def test_load_new_reads_each_file_once(spark, tmp):
    from medallion.operators import bronze

    landing, bpath = os.path.join(tmp, "landing"), os.path.join(tmp, "bronze")
    fixtures.write_landing(_orders(spark, ["a", "b"], "one"), landing)
    jobs.load_new(spark, landing, bpath)
    jobs.load_new(spark, landing, bpath)
    assert bronze.read(spark, bpath).count() == 2
    fixtures.write_landing(_orders(spark, ["c"], "two"), landing)
    jobs.load_new(spark, landing, bpath)
    assert bronze.read(spark, bpath).count() == 3
    assert len(jobs.bronze_loads(spark, bpath)) == 2


def test_build_publishes_views_that_survive_the_next_build(spark, tmp):
    from medallion.operators import bronze

    bpath, sroot, groot = (os.path.join(tmp, x) for x in ("bronze", "silver", "gold"))
    bronze.load_and_write(_orders(spark, ["a", "b"]), bpath, "l0", "2026-01-01 00:00:00")
    jobs.refresh_silver(spark, bpath, sroot)
    jobs.build(spark, sroot, groot, env="t1")
    before = spark.table("t1_gold.fct_orders")
    bronze.load_and_write(_orders(spark, ["c"]), bpath, "l1", "2026-01-02 00:00:00")
    jobs.refresh_silver(spark, bpath, sroot)
    jobs.build(spark, sroot, groot, env="t1")
    assert before.count() == 2  # a reader of the old build keeps its files
    assert spark.table("t1_gold.fct_orders").count() == 3
    jobs.build(spark, sroot, groot, env="t1", custom_schema=" t1_marts ")
    assert spark.table("t1_marts.mart_order_funnel").count() > 0


def test_readers_see_one_version_through_compaction_and_expiry(spark, tmp):
    from medallion import snapshots
    from medallion.operators import bronze
    from medallion.streaming import upkeep_batch
    from medallion.streaming.silver_stream import read_silver

    bpath, sroot = os.path.join(tmp, "bronze"), os.path.join(tmp, "silver")
    table = os.path.join(sroot, "dt_orders_created")

    def batch(i, ids):
        bronze.load_and_write(_orders(spark, ids), bpath, f"s{i}", f"2026-01-0{i + 1} 00:00:00")
        upkeep_batch(bronze.read_load(spark, bpath, f"s{i}"), i, sroot, names=["orders_created"])

    for i, ids in enumerate((["a", "b"], ["b", "c"], ["d"])):
        batch(i, ids)
    reader = read_silver(spark, sroot, "orders_created")
    before = sorted(tuple(r) for r in reader.collect())
    assert jobs.compact_silver(spark, sroot, "orders_created", keep_recent=1) == ["000000000000", "000000000001"]
    assert sorted(tuple(r) for r in reader.collect()) == before  # a reader from before has its folders
    assert sorted(tuple(r) for r in read_silver(spark, sroot, "orders_created").collect()) == before
    batch(1, ["b", "c"])  # a batch that has been compacted is taken in for good
    batch(3, ["a", "e"])  # the stream goes on
    assert sorted(r.event_id for r in read_silver(spark, sroot, "orders_created").collect()) == list("abcde")
    assert len(jobs.compact_silver(spark, sroot, "orders_created", keep_recent=1)) == 2
    # a rewritten folder that isn't published yet is invisible, and old folders go on request only
    now = snapshots.current(spark, table)
    dropped = jobs.expire(spark, [table], keep_versions=1)[table]
    assert [f for f in dropped if f.startswith("_batch=")] and not set(dropped) & {e.folder for e in now.entries}
    assert sorted(r.event_id for r in read_silver(spark, sroot, "orders_created").collect()) == list("abcde")
    assert {r.batch for r in now.of()} == {e.batch for e in snapshots.current(spark, table).of()}


def test_stream_sets_uncastable_rows_aside(spark, tmp):
    from medallion.operators import bronze
    from medallion.streaming import upkeep_batch
    from medallion.streaming.silver_stream import read_silver

    bpath, sroot = os.path.join(tmp, "bronze"), os.path.join(tmp, "silver")
    lines = _orders(spark, ["a"]).unionAll(_orders(spark, ["b"], amount="much"))
    bronze.load_and_write(lines, bpath, "s0", "2026-01-01 00:00:00")
    upkeep_batch(bronze.read_load(spark, bpath, "s0"), 0, sroot, names=["orders_created"], quarantine=True)
    assert [r.event_id for r in read_silver(spark, sroot, "orders_created").collect()] == ["a"]
    bad = spark.read.parquet(os.path.join(sroot, "dt_orders_created_quarantine")).collect()
    assert len(bad) == 1 and '"much"' in bad[0].raw_json


def test_both_branches_of_the_automatic_refresh_give_the_same_tables(spark, tmp):
    from medallion import snapshots
    from medallion.operators import bronze
    from medallion.streaming.silver_stream import read_silver

    got = {}
    for mode, full_above in (("incremental", 1.0), ("full", 0.0)):
        bpath, sroot = os.path.join(tmp, mode, "bronze"), os.path.join(tmp, mode, "silver")
        for i, ids in enumerate((["a", "b"], ["b", "c", "c"], ["a", "d"])):
            bronze.load_and_write(_orders(spark, ids, f"f{i}"), bpath, f"l{i}", f"2026-01-0{i + 1} 00:00:00")
            done = jobs.refresh_auto(spark, bpath, sroot, full_above)["orders_created"]
            assert done["mode"] == ("full" if i == 0 else mode) and 0 < done["new_bytes"] <= done["all_bytes"]
        table = os.path.join(sroot, "dt_orders_created")
        assert snapshots.current(spark, table).progress["auto"] == done
        again = jobs.refresh_auto(spark, bpath, sroot, 1.0)["orders_created"]
        assert (again["mode"], again["new_bytes"]) == ("incremental", 0)
        got[mode] = sorted(tuple(r) for r in read_silver(spark, sroot, "orders_created").collect())
    assert got["incremental"] == got["full"] and len(got["full"]) == 4
