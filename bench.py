"""Benchmark: the pipeline's headline jobs at one scale factor.

Inputs are the driver tables under ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]``. Setup (untimed) renders them as NDJSON event files.
Then, as a production run would, each layer is built from the stored layer
below it:

* ``bronze_load``      NDJSON files -> parse + per-file gate -> Bronze table (2 loads)
* ``silver_*``         Bronze table -> typed keep-first Silver (noop sink)
* Gold models          Silver/Gold tables -> model (noop sink)
* ``dq_suite``         the 117 declared checks over the stored tables
* ``u01..u07``         analytical questions over the stored tables
* ``stream_catch_up``  chained landing -> Bronze -> Silver stream, ``availableNow``
* ``upkeep``           ``UPKEEP_BATCHES`` small batches, half of them redeliveries, onto a filled Silver
                       table: time and ledger bytes of the first and the last ten (not part of the total)
* ``fct_orders_window_form`` the literal 4-window/4-join shape, for comparison
* ``skew_*``           fct_orders / fct_order_lifecycle with a third of all status
                       changes on one order (not part of the total)

Timed jobs report the median of ``$BENCH_REPEAT`` (default 3) warm runs.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from urllib.parse import unquote

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from medallion.contracts import SILVER_SPECS  # noqa: E402
from medallion.functions import date_key, day_boundaries, surrogate_key  # noqa: E402
from medallion.operators import bronze, ledger, quality, silver  # noqa: E402
from medallion.plans.warehouse import Warehouse  # noqa: E402
from medallion.session import local_session, scratch_path  # noqa: E402
from medallion.sources import fixtures  # noqa: E402
from medallion.sources.ndjson import read_lines  # noqa: E402
from medallion.streaming import run_available_now, start_ingest_stream, upkeep_batch  # noqa: E402
from medallion.streaming.silver_stream import read_silver  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
UPKEEP_BATCHES = 50
CALENDAR = ("1995-01-01", "2000-12-31")


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int = REPEAT) -> float:
    runs = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def fct_orders_window_form(oc: DataFrame, sc: DataFrame) -> DataFrame:
    """The source model's literal shape: 4 ROW_NUMBER windows + 4 left joins."""
    def top1(df, order):
        w = Window.partitionBy("order_id").orderBy(*order)
        return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")

    last = top1(sc, [F.col("changed_at").desc_nulls_last(), F.col("event_id").desc()]).select(
        "order_id", F.col("new_status").alias("current_status"), F.col("changed_at").alias("last_status_changed_at"))
    firsts = {}
    for s in ("paid", "shipped", "delivered"):
        firsts[s] = top1(sc.where(F.col("new_status") == s), [F.col("changed_at").asc_nulls_last()]).select(
            "order_id", F.col("changed_at").alias(f"{s}_at"))
    j = oc.join(last, "order_id", "left")
    for s in ("paid", "shipped", "delivered"):
        j = j.join(firsts[s], "order_id", "left")
    return j.select(
        surrogate_key("order_id").alias("order_sk"), "order_id", surrogate_key("customer_id").alias("customer_sk"),
        date_key("created_at").alias("created_date_key"), date_key("paid_at").alias("paid_date_key"),
        date_key("shipped_at").alias("shipped_date_key"), date_key("delivered_at").alias("delivered_date_key"),
        F.coalesce("current_status", F.lit("created")).alias("current_status"), F.col("amount").alias("order_amount"),
        "currency", "item_count", "created_at", "paid_at", "shipped_at", "delivered_at", "last_status_changed_at",
        day_boundaries("created_at", "paid_at").alias("days_to_paid"),
        day_boundaries("created_at", "shipped_at").alias("days_to_shipped"),
        day_boundaries("created_at", "delivered_at").alias("days_to_delivered"),
        F.col("delivered_at").isNotNull().alias("is_delivered"),
        F.coalesce(F.col("current_status").isin("delivered", "canceled"), F.lit(False)).alias("is_completed"),
    )


def upkeep(spark, root: str, lines: DataFrame) -> dict[str, float]:
    """Cost of a batch on a filled table, early and after many batches."""
    name = "orders_status_changed"
    lines = lines.where(F.contains("value", F.lit('"event_id":"sc-'))).select("value", "_source_file")
    lines.write.parquet(f"{root}/upkeep-lines")
    lines = spark.read.parquet(f"{root}/upkeep-lines")
    ledger.IDS_PER_BUCKET = 5_000  # buckets as a table a hundred times this size would have
    silver_root, seconds, read = f"{root}/upkeep", [], []
    whole, sizes = ledger._read, []

    def counting(*args):
        out = whole(*args)
        if out is not None:
            sizes.extend(os.path.getsize(unquote(f.removeprefix("file:").replace("//", "/", 1))) for f in out.inputFiles())
        return out

    ledger._read = counting
    upkeep_batch(bronze.load(lines, fixtures.FIRST_LOAD_AT, max_files=10_000), 0, silver_root, [name])
    for i in range(1, UPKEEP_BATCHES + 1):
        again = lines.where(F.pmod(F.xxhash64("value"), F.lit(20 * UPKEEP_BATCHES)) == i)
        fresh = again.withColumn("value", F.replace("value", F.lit('"event_id":"'), F.lit(f'"event_id":"n{i}-')))
        batch = bronze.load(again.unionAll(fresh), fixtures.REDELIVERY_AT, max_files=10_000)
        sizes.clear()
        t = time.perf_counter()
        upkeep_batch(batch, i, silver_root, [name])
        seconds.append(time.perf_counter() - t)
        read.append(sum(sizes))
    ledger._read = whole
    rows = read_silver(spark, silver_root, name)
    assert rows.count() == rows.select("event_id").distinct().count()
    mean = lambda x: round(statistics.mean(x), 3)
    return {"upkeep_first10_sec": mean(seconds[:10]), "upkeep_last10_sec": mean(seconds[-10:]),
            "upkeep_first10_kb": mean(x / 1024 for x in read[:10]), "upkeep_last10_kb": mean(x / 1024 for x in read[-10:])}


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS * 2))
    root = scratch_path(spark, "bench")
    landing, bronze_path = f"{root}/landing", f"{root}/bronze"
    silver_root, gold_root = f"{root}/silver", f"{root}/gold"
    q: dict[str, float] = {}
    info: dict[str, int | float] = {}

    # setup: driver tables -> NDJSON event files (two deliveries)
    t = time.perf_counter()
    for i, lines in enumerate(fixtures.deliveries(spark, SF_DIR)):
        fixtures.write_landing(lines, f"{landing}/d{i}")
    info["setup_sec"] = round(time.perf_counter() - t, 3)

    # Bronze: one load per delivery directory; each repeat loads into a fresh
    # table (Bronze appends), the last one feeds the layers above
    def load_bronze() -> None:
        nonlocal bronze_path
        bronze_path = scratch_path(spark, "bench-bronze")
        for i in range(2):
            lines = read_lines(spark, f"{landing}/d{i}")
            at = fixtures.FIRST_LOAD_AT if i == 0 else fixtures.REDELIVERY_AT
            bronze.load_and_write(lines, bronze_path, f"b{i}", at)

    q["bronze_load"] = timed(load_bronze)
    b = bronze.read(spark, bronze_path)
    info["bronze_rows"] = b.count()

    # Silver (batch full refresh)
    for name, spec in SILVER_SPECS.items():
        q[f"silver_{name}"] = timed(lambda: noop(silver.build(b, name)))
        silver.build(b, name).write.mode("overwrite").parquet(f"{silver_root}/{spec.table}")
    sv = {n: spark.read.parquet(f"{silver_root}/{s.table}") for n, s in SILVER_SPECS.items()}

    # Gold: each model timed over stored inputs, then stored for downstream
    w = Warehouse(spark, sv, calendar_start=CALENDAR[0], calendar_end=CALENDAR[1])
    order = ["dim_customers", "dim_date", "fct_orders", "fct_order_lifecycle",
             "mart_daily_revenue", "mart_order_funnel"]
    for name in order:
        q[name] = timed(lambda: noop(w.model(name)))
        w.model(name).write.mode("overwrite").parquet(f"{gold_root}/{name}")
        w.use(name, spark.read.parquet(f"{gold_root}/{name}"))

    q["fct_orders_window_form"] = timed(
        lambda: noop(fct_orders_window_form(w.stg_orders_created, w.stg_orders_status_changed)))

    # skew: a third of all status changes re-keyed to ONE order (the other
    # rows and the orders table unchanged); same jobs, same code
    sc = sv["orders_status_changed"]
    hot = sc.withColumn(
        "order_id",
        F.when(F.xxhash64("event_id") % 3 == 0, F.lit("ord-hot")).otherwise(F.col("order_id")),
    )
    hot.write.mode("overwrite").parquet(f"{silver_root}/skewed_status")
    ws = Warehouse(spark, {**sv, "orders_status_changed": spark.read.parquet(f"{silver_root}/skewed_status")},
                   calendar_start=CALENDAR[0], calendar_end=CALENDAR[1])
    q["skew_fct_orders"] = timed(lambda: noop(ws.fct_orders))
    q["skew_fct_order_lifecycle"] = timed(lambda: noop(ws.fct_order_lifecycle))

    # data-quality suite over stored tables
    def rel(name: str) -> DataFrame:
        if name.startswith("dt_"):
            return sv[name[3:]]
        return w.model(name)

    q["dq_suite"] = timed(lambda: quality.run(rel).collect())

    for key, fn in [
        ("u01_avg_days_to_delivery", w.avg_days_to_delivery),
        ("u02_aov_by_state", w.aov_by_state),
        ("u03_transition_gaps", w.transition_gaps),
        ("u04_status_transitions", w.status_transitions),
        ("u05_changes_over_time", w.changes_over_time),
        ("u06_revenue_seasonality", w.revenue_seasonality),
        ("u06_revenue_by_month", w.revenue_by_month),
        ("u07_revenue_by_status", w.revenue_by_status),
    ]:
        q[key] = timed(lambda: noop(fn()))

    # streaming catch-up: landing files -> Bronze stream -> Silver stream
    sroot = scratch_path(spark, "bench-stream")
    t = time.perf_counter()
    run_available_now(lambda tr: start_ingest_stream(
        spark, f"{landing}", f"{sroot}/bronze", f"{sroot}/silver", f"{sroot}/ck", trigger=tr,
        max_files_per_trigger=100_000))
    q["stream_catch_up"] = round(time.perf_counter() - t, 3)
    info["stream_rows_per_sec"] = round(info["bronze_rows"] / q["stream_catch_up"], 1)

    info |= upkeep(spark, scratch_path(spark, "bench-upkeep"), fixtures.deliveries(spark, SF_DIR)[0])

    headline = [k for k in q if k not in ("fct_orders_window_form", "skew_fct_orders", "skew_fct_order_lifecycle")]
    total = round(sum(q[k] for k in headline), 3)
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": q,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": CPUS,
        "repeat": REPEAT,
        **info,
    }))


if __name__ == "__main__":
    main()
