"""

Every query reads the driver tables under ``sf_dir``, renders them as domain
events (``medallion.sources.fixtures``: envelope NDJSON lines, two deliveries
with redelivered duplicates and a share of malformed telemetry lines) and
runs the whole pipeline on them through the library: Bronze parse + per-file
gate -> Silver typed extraction + keep-first dedupe -> staging -> Gold ->
marts / questions / data-quality suite. Nothing is capped or sampled.

Columns whose value is the wall clock of the run (the ``dbt_computed_at``
audit column) are not part of the models' default output; the two fixture
loads carry fixed load times so Silver's ``_ingested_at`` is reproducible.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from medallion.operators import bronze, quality  # noqa: E402
from medallion.plans import dimensions  # noqa: E402
from medallion.plans.warehouse import STAGING_MODELS, Warehouse  # noqa: E402
from medallion.session import apply_conf, scratch_path  # noqa: E402
from medallion.sources import fixtures  # noqa: E402
from medallion.sources.ndjson import read_lines  # noqa: E402

# The training-data operators are a subpackage that may be absent.
_llm = None
if all(importlib.util.find_spec(m) for m in ("corpus_pipeline", "medallion.llm")) and importlib.util.find_spec("medallion.llm.queries"):
    _llm = importlib.import_module("medallion.llm.queries")

# Calendar used by the Gold build over the driver tables (orders span
# 1995-2001; the 2001 orders fall outside and drop out of the revenue mart).
CALENDAR = ("1995-01-01", "2000-12-31")


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    apply_conf(spark)
    return Warehouse.from_bronze(
        spark,
        fixtures.fixture_bronze(spark, sf_dir),
        store=scratch_path(spark, "silver"),
        calendar_start=CALENDAR[0],
        calendar_end=CALENDAR[1],
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily revenue by state, end to end from the sf0.001 tables."""
    return _warehouse(spark, "/root/testdata/sf0.001").mart_daily_revenue


def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries landed as NDJSON files, each read back
    and loaded through the parser and the file gate."""
    apply_conf(spark)
    root = scratch_path(spark, "load-fixture")
    loads = (fixtures.FIRST_LOAD_AT, fixtures.REDELIVERY_AT)
    for i, (lines, at) in enumerate(zip(fixtures.deliveries(spark, sf_dir), loads)):
        fixtures.write_landing(lines, f"{root}/landing/d{i}")
        bronze.load_and_write(read_lines(spark, f"{root}/landing/d{i}"), f"{root}/bronze", f"d{i}", at)
    return bronze.read(spark, f"{root}/bronze").select(
        F.try_variant_get("raw_data", "$.event_id", "string").alias("event_id"),
        bronze.event_type().alias("event_type"),
        fixtures.logical_file("_source_file").alias("_source_file"),
        "_ingested_at",
    )


def bronze_reject_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file gate decisions of both fixture loads."""
    apply_conf(spark)
    first, again = fixtures.deliveries(spark, sf_dir)
    return bronze.file_report(bronze.parse_lines(first)).unionByName(
        bronze.file_report(bronze.parse_lines(again))
    )


def _silver(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _warehouse(spark, sf_dir).silver[name]

    q.__doc__ = f"Silver {name}: typed, keep-first per event_id."
    return q


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _warehouse(spark, sf_dir).model(name)

    q.__doc__ = f"Gold/staging model {name}."
    return q


def _question(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_warehouse(spark, sf_dir), name)()

    q.__doc__ = f"Analytical question {name}."
    return q


def _dq(test: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = _warehouse(spark, sf_dir)
        built: dict[str, DataFrame] = {}

        def rel(name: str) -> DataFrame:
            # as the suite runs over stored tables in production: a checked model is written
            # once and the models built on it read it there; Silver is stored already, and
            # staging is views of it
            if name not in built:
                if name.startswith("dt_"):
                    built[name] = w.silver[name[3:]]
                elif name in STAGING_MODELS:
                    built[name] = w.model(name)
                else:
                    path = scratch_path(spark, f"dq-{name}")
                    w.model(name).write.parquet(path)
                    built[name] = spark.read.parquet(path)
                    w.use(name, built[name])
            return built[name]

        return quality.run(rel, tests=[test])

    q.__doc__ = f"Data-quality suite, {test} checks."
    return q


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q01-Q05 with checks that the data break: ids of ``orders_created`` events
    before keep-first (redelivered ones repeat), keys that facts repeat, columns
    that stay empty until a status is reached, and statuses outside short lists."""
    from medallion.operators import silver

    w = _warehouse(spark, sf_dir)
    delivered = silver.extract(w.silver.bronze, "orders_created")
    relations = {"delivered_orders_created": delivered, "fct_orders": w.fct_orders,
                 "fct_order_lifecycle": w.fct_order_lifecycle, "dim_date": w.dim_date}
    check = quality.Check
    return quality.run(relations, [
        check("delivered_orders_created", "event_id", "unique"),
        check("fct_order_lifecycle", "order_id", "unique"),
        check("fct_orders", "customer_sk", "unique"),
        check("fct_orders", "paid_at", "not_null"),
        check("fct_orders", "delivered_at", "not_null"),
        check("fct_orders", "current_status", "accepted_values", ("created", "delivered")),
        check("fct_order_lifecycle", "old_status", "accepted_values", ("created",)),
        check("fct_order_lifecycle", "new_status", "accepted_values", ("paid", "shipped", "delivered")),
        check("fct_order_lifecycle", "changed_date_key", "relationships", to="dim_date", field="date_key"),
    ])


def _kept_delivery(table: DataFrame, name: str) -> DataFrame:
    from medallion.contracts import SILVER_SPECS

    return table.select(*[f.name for f in SILVER_SPECS[name].fields],
                        fixtures.logical_file("_source_file").alias("_source_file"))


def stream_silver_orders_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's two deliveries landed as NDJSON files, ingested by
    the Bronze stream and kept up by the Silver stream (``availableNow`` runs,
    one per delivery); returns Silver ``orders_created`` with the file of the kept
    delivery. ``_ingested_at`` (the stream's wall clock) is left out.
    """
    from medallion.streaming import run_available_now, start_bronze_stream, start_silver_stream
    from medallion.streaming.silver_stream import read_silver

    apply_conf(spark)
    root = scratch_path(spark, "stream-fixture")
    landing, bronze_path, silver_root = f"{root}/landing", f"{root}/bronze", f"{root}/silver"
    for lines in fixtures.deliveries(spark, sf_dir):
        fixtures.write_landing(lines, landing)
        run_available_now(lambda t: start_bronze_stream(
            spark, landing, bronze_path, f"{root}/_ckpt_bronze", trigger=t,
            max_files_per_trigger=100_000))
        run_available_now(lambda t: start_silver_stream(
            spark, bronze_path, silver_root, f"{root}/_ckpt_silver", trigger=t,
            names=["orders_created"]))
    return _kept_delivery(read_silver(spark, silver_root, "orders_created"), "orders_created")


def _stream_ingest(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from medallion.streaming import run_available_now, start_ingest_stream
        from medallion.streaming.silver_stream import read_silver

        apply_conf(spark)
        root = scratch_path(spark, "ingest-fixture")
        landing = f"{root}/landing"
        for lines in fixtures.deliveries(spark, sf_dir):
            fixtures.write_landing(lines, landing)
            run_available_now(lambda t: start_ingest_stream(
                spark, landing, f"{root}/bronze", f"{root}/silver", f"{root}/_ckpt", trigger=t,
                max_files_per_trigger=100_000))
        return _kept_delivery(read_silver(spark, f"{root}/silver", name), name)

    q.__doc__ = f"""T01-T04 through the chained stream: the fixture's two deliveries landed
    as NDJSON files and run through ``start_ingest_stream`` (each micro-batch
    writes its Bronze load and keeps all four Silver tables from that load), one
    ``availableNow`` run per delivery; returns Silver ``{name}`` with the
    file of the kept delivery (the stream's load times are left out)."""
    return q


def stream_replay_compact_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver upkeep through what happens to a running system.
    The first delivery's batch is replayed with a load time on another day, the
    redelivery follows, Bronze is compacted twice into one id, Silver is refreshed
    from it and the redelivery comes once more. Returns each Silver table's ids as
    ``Warehouse.from_tables`` reads them, with the kept delivery's file and load time."""
    from medallion import jobs
    from medallion.contracts import SILVER_SPECS
    from medallion.streaming import upkeep_batch

    apply_conf(spark)
    root = scratch_path(spark, "upkeep-fixture")
    path, silver_root = f"{root}/bronze", f"{root}/silver"
    first, again = fixtures.deliveries(spark, sf_dir)

    def batch(lines: DataFrame, batch_id: int, at: str) -> None:
        load_id = f"s{batch_id:012d}"
        bronze.load_and_write(lines, path, load_id, at)
        upkeep_batch(bronze.read_load(spark, path, load_id), batch_id, silver_root)

    batch(first, 0, "2025-12-31 23:59:00")
    batch(first, 0, fixtures.FIRST_LOAD_AT)
    batch(again, 1, fixtures.REDELIVERY_AT)
    jobs.compact_bronze(spark, path, "c0", keep_recent=1)
    jobs.compact_bronze(spark, path, "c0", keep_recent=0)
    jobs.refresh_silver(spark, path, silver_root)
    batch(again, 2, "2026-01-09 00:00:00")
    kept = Warehouse.from_tables(spark, silver_root).silver
    parts = [kept[n].select(F.lit(n).alias("table_name"), "event_id", "_source_file", "_ingested_at") for n in SILVER_SPECS]
    return parts[0].unionAll(parts[1]).unionAll(parts[2].unionAll(parts[3]))


def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams on one Bronze and one Silver root. The first delivery and the
    redelivery land in folders of their own with a stream each; then the second stream
    starts again with a fresh checkpoint and reads its folder once more. Returns every
    delivery that Bronze holds of the domain's events, and what Silver has kept."""
    from medallion.contracts import SILVER_SPECS
    from medallion.streaming import run_available_now, start_ingest_stream
    from medallion.streaming.silver_stream import read_silver

    apply_conf(spark)
    root = scratch_path(spark, "two-sources")
    path, silver_root = f"{root}/bronze", f"{root}/silver"
    for i, lines in enumerate(fixtures.deliveries(spark, sf_dir)):
        fixtures.write_landing(lines, f"{root}/landing{i}")
    for i, checkpoint in ((0, "a"), (1, "b"), (1, "c")):
        run_available_now(lambda t: start_ingest_stream(
            spark, f"{root}/landing{i}", path, silver_root, f"{root}/_ckpt_{checkpoint}", trigger=t, max_files_per_trigger=100_000))
    stored = bronze.read(spark, path).where(F.col("_event_type") != bronze.OTHER_EVENT_TYPE)
    parts = [stored.select(F.lit("bronze").alias("table_name"), F.try_variant_get("raw_data", "$.event_id", "string").alias("event_id"), "_source_file")]
    parts += [read_silver(spark, silver_root, n).select(F.lit(n).alias("table_name"), "event_id", "_source_file") for n in SILVER_SPECS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.withColumn("_source_file", fixtures.logical_file("_source_file"))


def notified_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domain's events of both deliveries go through the sink with the landing contract's
    file names; the stream reads the files that the notifications name. Returns Silver ``orders_created``
    (names are random, so files and load times are left out)."""
    from medallion.contracts import SILVER_SPECS
    from medallion.sources.ndjson import publish_events
    from medallion.streaming import run_available_now, start_notified_stream
    from medallion.streaming.silver_stream import read_silver

    apply_conf(spark)
    root = scratch_path(spark, "notified")
    domain = fixtures.domain_lines(spark, sf_dir)
    for lines in (domain, domain.where("_redeliver")):
        publish_events(lines, f"{root}/landing", notify=f"{root}/notifications")
        run_available_now(lambda t: start_notified_stream(
            spark, f"{root}/notifications", f"{root}/landing", f"{root}/bronze", f"{root}/_ckpt", silver_root=f"{root}/silver", trigger=t))
    kept = read_silver(spark, f"{root}/silver", "orders_created")
    return kept.select(*[f.name for f in SILVER_SPECS["orders_created"].fields])


def silver_refresh_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T02 (``REFRESH_MODE = AUTO``): Silver brought up to date after each of three loads, the two deliveries and the
    redelivery once more: a full refresh first, then whichever the measured bytes of the new
    loads call for. Returns each table's ids with the kept delivery, and the recorded choices."""
    from medallion import jobs
    from medallion.contracts import SILVER_SPECS
    from medallion.streaming.silver_stream import read_silver

    apply_conf(spark)
    root = scratch_path(spark, "auto-refresh")
    first, again = fixtures.deliveries(spark, sf_dir)
    choices = []
    for i, (lines, at) in enumerate(((first, fixtures.FIRST_LOAD_AT), (again, fixtures.REDELIVERY_AT), (again, "2026-01-09 00:00:00"))):
        bronze.load_and_write(lines, f"{root}/bronze", f"d{i}", at)
        done = jobs.refresh_auto(spark, f"{root}/bronze", f"{root}/silver", full_above=0.5)
        choices += [(f"choice {i}", f"{n}: {done[n]['mode']}", None) for n in SILVER_SPECS]
    out = spark.createDataFrame(choices, "table_name string, event_id string, _source_file string")
    for n in SILVER_SPECS:
        out = out.unionAll(read_silver(spark, f"{root}/silver", n).select(F.lit(n).alias("table_name"), "event_id", "_source_file"))
    return out


def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the first delivery, the amount of every seventh turned into text,
    through Silver upkeep that sets rows with uncastable values aside."""
    from medallion.streaming import upkeep_batch
    from medallion.streaming.silver_stream import read_quarantine, read_silver

    apply_conf(spark)
    root = scratch_path(spark, "quarantine")
    first, _ = fixtures.deliveries(spark, sf_dir)
    key = F.regexp_extract("value", '"event_id":"oc-([0-9]+)"', 1)
    broken = F.when(key.try_cast("long") % 7 == 0, F.regexp_replace("value", '"amount":[0-9.]+', '"amount":"n/a"')).otherwise(F.col("value"))
    bronze.load_and_write(first.where(key != "").withColumn("value", broken), f"{root}/bronze", "d0", fixtures.FIRST_LOAD_AT)
    upkeep_batch(bronze.read_load(spark, f"{root}/bronze", "d0"), 0, f"{root}/silver", ["orders_created"], quarantine=True)
    kept = read_silver(spark, f"{root}/silver", "orders_created").select("event_id", "amount", F.lit(False).alias("set_aside"))
    aside = read_quarantine(spark, f"{root}/silver", "orders_created")
    aside = aside.select(F.get_json_object("raw_json", "$.event_id").alias("event_id"), F.lit(None).cast("decimal(10,2)").alias("amount"), F.lit(True).alias("set_aside"))
    return kept.unionAll(aside)


def gold_build_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh, a Gold build after the first delivery, then one after
    the redelivery, published as catalog views in a routed schema. Returns the orders of the newest version, as
    the view shows them, with whether each has its audit time and whether the earlier build is still readable."""
    from medallion import jobs, materialize, snapshots

    apply_conf(spark)
    root = scratch_path(spark, "published")
    path, silver_root, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    schema = "published_" + root.rsplit("-", 1)[-1]
    seen = []
    for i, (lines, at) in enumerate(zip(fixtures.deliveries(spark, sf_dir), (fixtures.FIRST_LOAD_AT, fixtures.REDELIVERY_AT))):
        bronze.load_and_write(lines, path, f"d{i}", at)
        jobs.refresh_silver(spark, path, silver_root)
        jobs.build(spark, silver_root, gold, calendar=CALENDAR, env="driver", custom_schema=f" {schema} ")
        seen.append(snapshots.current(spark, gold))
    view = spark.table(f"{schema}.fct_orders")
    earlier = materialize.read_gold(spark, gold, "fct_orders", seen[0]).select("order_sk", F.lit(True).alias("in_earlier_build"))
    return view.join(earlier, "order_sk", "left").select(
        *[c for c in view.columns if c != "dbt_computed_at"], F.col("dbt_computed_at").isNotNull().alias("audited"),
        F.coalesce("in_earlier_build", F.lit(False)).alias("in_earlier_build"))


def unique_customers_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per state and month, re-aggregated from the stored
    daily bitmaps of numbered customers."""
    from medallion.functions.bitmaps import numbered
    from medallion.plans import marts, questions

    w = _warehouse(spark, sf_dir)
    root = scratch_path(spark, "daily-customers")
    w.dim_customers.select("customer_sk", F.col("state").alias("customer_state")).write.parquet(f"{root}/customers")
    states = spark.read.parquet(f"{root}/customers")
    first = states.groupBy("customer_sk").agg(F.min("customer_state").alias("state"))
    first.write.parquet(f"{root}/keys")
    numbers = numbered(spark.read.parquet(f"{root}/keys"), "customer_sk", ["state"])
    numbers.select("customer_sk", "member_no").write.parquet(f"{root}/numbers")
    members = states.join(spark.read.parquet(f"{root}/numbers"), "customer_sk")
    marts.mart_daily_customers(w.fct_orders, members).write.parquet(f"{root}/daily")
    return questions.unique_customers_by_month(spark.read.parquet(f"{root}/daily"))


def dim_date_spanning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar covering the order-creation days found in the data."""
    w = _warehouse(spark, sf_dir)
    return dimensions.calendar_spanning(w.stg_orders_created, "created_at")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "bronze_load": bronze_load,
        "bronze_reject_gate": bronze_reject_gate,
    }
    for name in ("orders_created", "orders_status_changed", "customers_registered", "customers_updated"):
        q[f"silver_{name}"] = _silver(name)
        q[f"stg_{name}"] = _model(f"stg_{name}")
    q["dim_customers"] = _model("dim_customers")
    q["dim_date"] = dim_date_spanning
    q["stream_silver_orders_created"] = stream_silver_orders_created
    for name in ("orders_status_changed", "customers_registered", "customers_updated"):
        q[f"stream_ingest_{name}"] = _stream_ingest(name)
    q["stream_replay_compact_refresh"] = stream_replay_compact_refresh
    q["stream_two_sources"] = stream_two_sources
    q["notified_ingest_orders"] = notified_ingest_orders
    q["silver_refresh_auto"] = silver_refresh_auto
    q["silver_quarantine"] = silver_quarantine
    q["gold_build_published"] = gold_build_published
    for name in ("fct_orders", "fct_order_lifecycle", "mart_daily_revenue", "mart_order_funnel"):
        q[name] = _model(name)
    for t in ("unique", "not_null", "accepted_values", "relationships"):
        q[f"dq_{t}"] = _dq(t)
    q["dq_violations"] = dq_violations
    for name in (
        "avg_days_to_delivery",
        "aov_by_state",
        "transition_gaps",
        "status_transitions",
        "changes_over_time",
        "revenue_seasonality",
        "revenue_by_month",
        "revenue_by_status",
    ):
        q[name] = _question(name)
    q["unique_customers_by_month"] = unique_customers_by_month
    if _llm is not None:
        q |= _llm.queries()
    return q


def oracle_sql() -> dict[str, str]:
    from duckdb_oracle import oracle_sql as _oracle

    return _oracle() | (_llm.oracle_sql() if _llm is not None else {})
