"""Driver tables rendered as domain-event NDJSON lines (FIXTURES.md section 3).

This module only produces *input*: envelope lines ``(value, _source_file)`` in
the shape the producer writes. It does none of the pipeline's work (no
parsing, gating, dedupe or modelling); those run in ``operators``/``plans`` on
whatever lines they are given.

Mapping (all per row, no collect):

* ``customer`` ⋈ ``nation``                 -> ``customer_registered``
* ``events`` signup/view                    -> ``customer_updated``
* ``orders`` ⟕ line counts of ``lineitem``  -> ``order_created``
* ``orders`` (four legs)                    -> ``order_status_changed``
* ``events`` click/purchase/error           -> telemetry envelopes of other
  types; ``error`` rows are written truncated (a partial write), so telemetry
  files exercise the per-file reject gate.

Every domain event whose numeric key is a multiple of 10 is delivered a
second time in a later load from another file (at-least-once redelivery).
Domain envelopes are grouped into one file per event kind and month
(``events/events-YYYYMM-<kind>.ndjson``, redeliveries under
``events/retry/``); telemetry into hourly files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion.session import shuffles_dropped
from medallion.sources.ndjson import envelope_json

# Load times of the two deliveries used by the fixture's Bronze.
FIRST_LOAD_AT = "2026-01-01 00:00:00"
REDELIVERY_AT = "2026-01-01 01:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n.cast("int"), ts)


def _file(prefix: str, ts: Column, kind: str) -> Column:
    return F.concat(
        F.lit(prefix), F.date_format(ts, "yyyyMM"), F.lit(f"-{kind}.ndjson")
    )


def _domain(event_id, event_type, ts, payload, key, kind) -> list[Column]:
    return [
        envelope_json(event_id, F.lit(event_type), ts, payload, C.EVENT_VERSION).alias("value"),
        _file("events/events-", ts, kind).alias("_source_file"),
        _file("events/retry/events-", ts, kind).alias("_retry_file"),
        (key % 10 == 0).alias("_redeliver"),
    ]


def order_created_at(orders: DataFrame) -> Column:
    return _minutes(F.col("o_orderdate"), F.col("o_orderkey") % 1440)


def domain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All domain envelopes with their file and redelivery flag."""
    customer = _t(spark, sf_dir, "customer")
    nation = _t(spark, sf_dir, "nation")
    events = _t(spark, sf_dir, "events")
    orders = _t(spark, sf_dir, "orders")
    lineitem = _t(spark, sf_dir, "lineitem")

    registered = customer.join(
        nation, customer.c_nationkey == nation.n_nationkey, "left"
    ).select(
        *_domain(
            F.concat(F.lit("cr-"), F.col("c_custkey").cast("string")),
            C.CUSTOMER_REGISTERED,
            F.lit("1994-12-31 00:00:00").cast("timestamp_ntz"),
            F.struct(
                F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("customer_id"),
                F.col("c_name").alias("name"),
                F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
                F.col("n_name").alias("state"),
            ),
            F.col("c_custkey"),
            "customers",
        )
    )

    ts_sec = F.date_trunc("SECOND", F.col("ts")).cast("timestamp_ntz")
    is_signup = F.col("event_type") == "signup"
    updated = events.where(F.col("event_type").isin("signup", "view")).select(
        *_domain(
            F.concat(F.lit("cu-"), F.col("event_id").cast("string")),
            C.CUSTOMER_UPDATED,
            ts_sec,
            F.struct(
                F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
                F.when(is_signup, F.lit("email")).otherwise(F.lit("state")).alias("field_changed"),
                F.lit("prev").alias("old_value"),
                F.when(
                    is_signup,
                    F.concat(F.lit("u"), F.col("event_id").cast("string"), F.lit("@example.com")),
                ).otherwise(
                    F.concat(F.lit("NATION_"), (F.col("event_id") % 25).cast("string"))
                ).alias("new_value"),
            ),
            F.col("event_id"),
            "updates",
        )
    )

    # Line counts per order: partial aggregation before the shuffle, then one
    # shuffle join with orders on the order key.
    line_counts = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    order_base = orders.join(
        line_counts, orders.o_orderkey == line_counts.l_orderkey, "left"
    ).select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        order_created_at(orders).alias("created_at"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("item_count"),
    )
    order_id = F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string"))
    created = order_base.select(
        *_domain(
            F.concat(F.lit("oc-"), F.col("o_orderkey").cast("string")),
            C.ORDER_CREATED,
            F.col("created_at"),
            F.struct(
                order_id.alias("order_id"),
                F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("customer_id"),
                F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
                F.lit("BRL").alias("currency"),
                F.col("item_count"),
            ),
            F.col("o_orderkey"),
            "orders",
        )
    )

    # A status change needs nothing of the order's lines.
    k = F.col("o_orderkey")
    live = k % 5 != 0
    legs = [
        ("paid", "created", live, k % 72 * 60 + 30),
        ("shipped", "paid", live & F.col("o_orderstatus").isin("F", "P"), (k % 200 + 72) * 60),
        ("delivered", "shipped", live & (F.col("o_orderstatus") == "F"), (k % 300 + 300) * 60),
        ("canceled", "created", k % 10 == 0, k % 48 * 60),
    ]
    changes = orders.select("o_orderkey", "o_orderstatus", order_created_at(orders).alias("created_at"))
    status_frames = []
    for new, old, cond, offset_min in legs:
        changed_at = _minutes(F.col("created_at"), offset_min)
        status_frames.append(
            changes.where(cond).select(
                *_domain(
                    F.concat(F.lit("sc-"), k.cast("string"), F.lit(f"-{new}")),
                    C.ORDER_STATUS_CHANGED,
                    changed_at,
                    F.struct(
                        order_id.alias("order_id"),
                        F.lit(old).alias("old_status"),
                        F.lit(new).alias("new_status"),
                    ),
                    k,
                    "status",
                )
            )
        )
    out = registered.unionByName(updated).unionByName(created)
    for f in status_frames:
        out = out.unionByName(f)
    return out


def telemetry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-domain envelopes; ``error`` rows are truncated (malformed JSON)."""
    events = _t(spark, sf_dir, "events").where(
        F.col("event_type").isin("click", "purchase", "error")
    )
    ts_sec = F.date_trunc("SECOND", F.col("ts")).cast("timestamp_ntz")
    full = envelope_json(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")),
        F.col("event_type"),
        ts_sec,
        F.struct("user_id", "value", "props"),
        C.EVENT_VERSION,
    )
    value = F.when(
        F.col("event_type") == "error", F.expr("substring(__full, 1, length(__full) - 1)")
    ).otherwise(F.col("__full"))
    return (
        events.select(full.alias("__full"), "event_type", "ts")
        .select(
            value.alias("value"),
            F.concat(
                F.lit("events/telemetry-"),
                F.date_format(F.col("ts"), "yyyyMMdd-HH"),
                F.lit(".ndjson"),
            ).alias("_source_file"),
        )
    )


def deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first delivery, redelivery) as lines frames ``(value, _source_file)``."""
    dom = domain_lines(spark, sf_dir)
    first = dom.select("value", "_source_file").unionByName(telemetry_lines(spark, sf_dir))
    again = dom.where("_redeliver").select("value", F.col("_retry_file").alias("_source_file"))
    return first, again


def fixture_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze table after two loads of the fixture deliveries: the library's load
    writes each into the shared scratch folder, and the table is read from there."""
    from medallion.operators import bronze
    from medallion.session import scratch_path

    path = scratch_path(spark, "bronze")
    for i, (lines, at) in enumerate(zip(deliveries(spark, sf_dir), (FIRST_LOAD_AT, REDELIVERY_AT))):
        bronze.load_and_write(lines, path, f"d{i}", at)
    return bronze.read(spark, path)


def logical_file(path: str) -> Column:
    """The name of the file a landed line belongs to: ``write_landing`` keeps it,
    escaped, as a folder name, and ``_metadata.file_path`` escapes that once more."""
    return F.url_decode(F.url_decode(F.regexp_extract(path, "_source_file=([^/]+)/", 1)))


def write_landing(lines: DataFrame, landing_path: str) -> None:
    """Write lines as NDJSON files, one physical file per ``_source_file``.

    Rows are clustered by file first so each logical file becomes exactly one
    part file (the per-file gate then sees the same files a batch load sees). The files are
    compressed, as the lines take ten times the disk of the tables they come from.
    """
    with shuffles_dropped(lines.sparkSession):
        (
            lines.repartition("_source_file")
            .write.mode("append")
            .partitionBy("_source_file")
            .text(landing_path, compression="gzip")
        )
