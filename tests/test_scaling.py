"""What large inputs must not pay for: steps done once, whatever builds on them."""

import datetime as dt

from pyspark.sql import functions as F

from medallion.operators import bronze
from medallion.sources import fixtures
from medallion.sources.ndjson import iso_utc


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _tables(spark, root, n=40):
    k = F.col("id")
    rows = spark.range(n)
    day = F.timestamp_add("DAY", k.cast("int"), F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))
    tables = {
        "customer": rows.select(k.alias("c_custkey"), F.format_string("C%d", k).alias("c_name"), (k % 3).cast("int").alias("c_nationkey")),
        "nation": spark.range(3).select(k.cast("int").alias("n_nationkey"), F.format_string("N%d", k).alias("n_name")),
        "orders": rows.select(k.alias("o_orderkey"), (k % 7).alias("o_custkey"), F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
                              (k * 10.5).alias("o_totalprice"), day.alias("o_orderdate")),
        "lineitem": rows.select((k % 13).alias("l_orderkey")),
        "events": rows.select(k.alias("event_id"), day.alias("ts"), (k % 7).alias("user_id"),
                              F.element_at(F.array(*map(F.lit, ("signup", "view", "click", "error"))), (k % 4 + 1).cast("int")).alias("event_type"),
                              (k * 0.5).alias("value"), F.lit('{"k": 1}').alias("props")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_lines_of_the_status_changes_need_no_line_items(spark, tmp_path):
    dom = fixtures.domain_lines(spark, _tables(spark, tmp_path))
    assert _plan(dom).count("Relation [l_orderkey") == 1
    kinds = dict(dom.groupBy(F.get_json_object("value", "$.payload.new_status")).count().collect())
    assert kinds == {None: 40 + 20 + 40, "paid": 32, "shipped": 21, "delivered": 11, "canceled": 4}


def test_a_computed_line_is_computed_once(spark):
    rendered = spark.range(3).select(F.to_json(F.struct("id")).alias("value"), F.lit("f").alias("_source_file"))
    assert _plan(bronze.parse_lines(rendered)).count("struct(id") == 1


def test_lines_are_parsed_without_copies_out_of_a_wrapping_array(spark):
    cases = ['{"a":1}', ' [1,2] ', '1,2', '1]', '1] x', '{"a":[1]}', '{"a":1}{"b":2}', '{"a":1}]', '"x]"', '"x"] y', 'true', 'true]', '1,true]', '{"a":1,"a":2}', '{"a":1', '  ', "", None]
    lines = spark.createDataFrame([(c, "f") for c in cases], "value string, _source_file string")
    parsed = bronze.parse_lines(lines)
    assert "variantget" not in _plan(parsed).lower().replace("_", "")
    good = sorted(r[0] for r in parsed.where("NOT _bad").select(F.to_json("raw_data")).collect())
    assert good == sorted(['{"a":1}', "[1,2]", '{"a":[1]}', '"x]"', "true"])
    assert parsed.count() == len(cases) - 3


def test_iso_utc_of_years_that_are_not_four_digits(spark):
    day = lambda *a: dt.datetime(*a)
    rows = spark.createDataFrame([(0, day(1999, 1, 2, 3, 4, 5, 600000)), (1, day(1, 1, 1)), (2, None)], "k int, t timestamp_ntz")
    rows = rows.unionAll(spark.sql("SELECT 3, make_timestamp_ntz(12345, 6, 7, 8, 9, 10)"))
    got = [r[0] for r in rows.orderBy("k").select(iso_utc(F.col("t"))).collect()]
    assert got == ["1999-01-02T03:04:05Z", "0001-01-01T00:00:00Z", "null-null-nullTnull:null:nullZ", "12345-06-07T08:09:10Z"]


def test_a_check_stores_a_model_once_and_copies_no_stored_silver(spark, tmp_path):
    import glob

    import __spark_entry__ as entry
    from medallion.session import checkpoint_root

    folder = lambda: set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/dq-*"))
    before = folder()
    report = entry.queries()["dq_not_null"](spark, _tables(spark, tmp_path))
    stored = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in folder() - before}
    assert stored == {"dq-dim_customers", "dq-dim_date", "dq-fct_orders", "dq-fct_order_lifecycle",
                      "dq-mart_daily_revenue", "dq-mart_order_funnel", "dq-dim_products"}
    assert {r["relation"] for r in report.collect()} >= {"stg_orders_created", "dt_orders_created", "mart_daily_revenue"}


def test_a_first_batch_is_not_persisted(spark, tmp_path, monkeypatch):
    from medallion.operators import silver
    from medallion.streaming import upkeep_batch
    from medallion.streaming.silver_stream import read_silver

    asked = []
    dedupe = silver.dedupe

    def watched(typed):
        rows = dedupe(typed)
        persist = rows.persist
        rows.persist = lambda *a: (asked.append(1), persist(*a))[1]
        return rows

    monkeypatch.setattr(silver, "dedupe", watched)
    first, again = fixtures.deliveries(spark, _tables(spark, tmp_path))
    for i, (lines, kept) in enumerate(((first, 0), (again, 1))):
        bronze.load_and_write(lines, f"{tmp_path}/bronze", f"d{i}", f"2026-01-0{i + 1} 00:00:00")
        upkeep_batch(bronze.read_load(spark, f"{tmp_path}/bronze", f"d{i}"), i, f"{tmp_path}/silver", ["orders_created"])
        assert len(asked) == kept
    assert read_silver(spark, f"{tmp_path}/silver", "orders_created").count() == 40


def test_an_id_is_hashed_once_for_its_bloom_bits(spark, tmp):
    from medallion.operators import ledger

    ids = spark.range(6000).select(F.format_string("e-%d", "id").alias("event_id"))
    shape = ledger.write_segment(ids.where("event_id < 'e-5'"), f"{tmp}/s0")
    assert shape["blocks"]
    known, passed = ledger.known(ids, [(f"{tmp}/s0", shape)])
    assert passed._jdf.queryExecution().analyzed().toString().count("xxhash64(event_id") < 10
    want = {f"e-{i}" for i in range(6000) if f"e-{i}" < "e-5"}
    assert {r[0] for r in known.collect()} == want
    blooms = spark.read.parquet(f"{tmp}/s0/bloom")
    bits = blooms.selectExpr("+".join(f"bit_count(w{w})" for w in range(ledger.WORDS)) + " AS n").agg(F.sum("n")).first()[0]
    assert 0.7 * ledger.PROBES * len(want) < bits <= ledger.PROBES * len(want)
    passed.unpersist()
