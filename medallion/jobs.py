"""End-to-end jobs: load, refresh, build.

``build`` is the Gold build: models are written in dependency levels, the
models of one level concurrently (threads submitting Spark jobs, as the
source project's build runs up to four models at once), each level reading
the tables the previous level wrote; then the data-quality suite runs over
the stored tables and its report is stored too.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import contracts as C
from medallion import materialize, snapshots
from medallion.operators import bronze, quality, silver
from medallion.plans.warehouse import Warehouse
from medallion.session import shuffles_dropped
from medallion.sources.ndjson import read_lines
from medallion.streaming import run_available_now, start_bronze_stream, upkeep_batch
from medallion.streaming.silver_stream import id_segment, unread_loads

# Silver's batch of a full refresh.
REFRESH_BATCH = "refresh"
COMPACTION = "compaction"
# Writers whose batches are never replayed.
UPKEEP = (REFRESH_BATCH, COMPACTION)

# Dependency levels of the Gold graph (models in a level are independent).
GOLD_LEVELS = [
    ["dim_products", "dim_customers", "dim_date", "fct_orders", "fct_order_lifecycle"],
    ["mart_daily_revenue", "mart_order_funnel"],
]


def load(spark: SparkSession, landing: str, bronze_path: str, load_id: str) -> None:
    """One batch load of every file under ``landing`` into Bronze.

    No file list is pulled into Python: the gate resolves and counts the
    accepted files on the cluster before deciding to broadcast them.
    Every file under ``landing`` is read; ``load_new`` reads each file once.
    """
    bronze.load_and_write(read_lines(spark, landing), bronze_path, load_id)


def load_new(spark: SparkSession, landing: str, bronze_path: str) -> None:
    """E1 with a load history (S04): the files of ``landing`` not loaded before.

    The history is the checkpoint of a file source that runs until it has
    caught up, kept per landing folder beside Bronze's loads; only new files
    are read. A run that was lost is repeated under its own load id.
    """
    key = hashlib.sha256(landing.rstrip("/").encode()).hexdigest()[:12]
    run_available_now(lambda trigger: start_bronze_stream(
        spark, landing, bronze_path, f"{bronze_path.rstrip('/')}/_history/{key}", trigger=trigger,
        max_files_per_trigger=None, prefix=f"h{key}-"))


def bronze_loads(spark: SparkSession, bronze_path: str) -> list[str]:
    """Load ids of Bronze's newest version, oldest first (no data read)."""
    now = snapshots.current(spark, bronze_path)
    return [e.batch for e in sorted(now.of(), key=_age)]


def _age(e: snapshots.Entry) -> int:
    """The version of a folder's newest rows."""
    return e.info.get("covers", e.version)


def _oldest(now: snapshots.Snapshot, keep_recent: int) -> list[snapshots.Entry]:
    """All but the ``keep_recent`` newest folders, and the newest one of each stream,
    whose batch may be replayed."""
    rows = sorted(now.of(), key=_age)
    newest = {e.stream: e for e in rows if e.stream not in (None, *UPKEEP)}
    return [e for e in rows[: max(0, len(rows) - keep_recent)] if newest.get(e.stream) is not e]


def compact_bronze(
    spark: SparkSession, bronze_path: str, into: str, keep_recent: int = 60
) -> list[str]:
    """Rewrite all but the ``keep_recent`` newest loads into one load ``into``.

    The rows are copied unchanged (same ``_source_file`` and ``_ingested_at``); one
    version then has the new folder in place of the old ones, which readers of earlier
    versions keep until ``expire``. An id in use gets a suffix.
    Returns the compacted load ids.
    """
    root = bronze_path.rstrip("/")
    now = snapshots.begin(spark, root)
    old = _oldest(now, keep_recent)
    if len(old) < 2 and all("covers" in e.info for e in old):
        return []
    if into in {e.batch for e in now.of()}:
        into = f"{into}-{snapshots.fresh_id()}"
    folder = f"_load={into}/_try={snapshots.fresh_id()}"
    rows = bronze.read_entries(spark, now, old)
    _copy_by_type(rows.drop("_load"), f"{root}/{folder}")
    written = spark.read.schema(bronze.STAGED_SCHEMA).parquet(f"{root}/{folder}").count()
    if written != rows.count():
        raise RuntimeError(f"compaction into {into} wrote {written} rows; the loads are kept")
    new = snapshots.Entry(folder, stream=COMPACTION, batch=into, info={"covers": max(map(_age, old))})
    snapshots.publish(spark, root, lambda v: snapshots.swapping(v, old, [new]))
    return [e.batch for e in old]


def _copy_by_type(rows: DataFrame, folder: str, threads: int = 4) -> None:
    """Stored Bronze rows in a folder of each event type, each type copied by a job of its own: they lie in
    folders already, and one job for all types would sort the rows by type, which spills at size."""
    spark = rows.sparkSession
    fs, target = snapshots.file_system(spark, folder)
    fs.mkdirs(target)
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString

    def copy(kind: str | None) -> None:
        one = rows.where(F.col("_event_type").eqNullSafe(kind)).drop("_event_type")
        one.write.mode("overwrite").parquet(f"{folder}/{name('_event_type', kind)}")

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        list(pool.map(copy, [r[0] for r in rows.select("_event_type").distinct().collect()]))


def compact_silver(spark: SparkSession, silver_root: str, name: str, keep_recent: int = 60) -> list[str]:
    """Rewrite all but the ``keep_recent`` newest batch folders of a Silver table into one.

    A reader sees the old folders or the new one, in one step, also while batches
    are being published; the ids of the rows stay where they are in the ledger.
    Returns the rewritten batches.
    """
    spec = C.SILVER_SPECS[name]
    path = f"{silver_root.rstrip('/')}/{spec.table}"
    now = snapshots.begin(spark, path)
    old = _oldest(now, max(1, keep_recent))
    if len(old) < 2:
        return []
    stored = snapshots.read(spark, now, silver.table_schema(spec), entries=old).select(*spec.columns)
    batch = f"c-{snapshots.fresh_id()}"
    folder = f"_batch={batch}/_try=0"
    silver.dedupe(stored).write.mode("overwrite").parquet(f"{path}/{folder}")
    written = spark.read.schema(silver.table_schema(spec)).parquet(f"{path}/{folder}").count()
    if written != stored.select("event_id").distinct().count():
        raise RuntimeError(f"compaction into {batch} has lost ids; the old folders are kept")
    new = snapshots.Entry(folder, stream=COMPACTION, batch=batch, info={"covers": max(map(_age, old))})
    snapshots.publish(spark, path, lambda v: snapshots.swapping(v, old, [new]))
    return [e.batch for e in old]


def expire(spark: SparkSession, roots: list[str], keep_versions: int = 100) -> dict[str, list[str]]:
    """Drop all but the newest versions of the tables at ``roots`` (Bronze, a Silver
    table, Gold), and the folders that only they name. Readers of dropped versions
    lose their files."""
    return {r: snapshots.expire(spark, r, keep_versions) for r in roots}


def refresh_silver(
    spark: SparkSession, bronze_path: str, silver_root: str, threads: int = 4,
    names: list[str] | None = None, progress: dict[str, dict] | None = None,
) -> dict[str, str]:
    """E2 (full refresh, S15): rebuild every Silver table from all of Bronze.

    The four tables read disjoint Bronze partitions and are written by
    concurrently submitted jobs. Each is replaced in one step, with its id ledger; if a
    batch is published while it is being rebuilt, it is rebuilt again, so that no row of that batch is
    lost or there twice. The stream goes on from a refreshed table. ``names`` limits it to some tables; ``progress`` is published
    with a table, by table.
    """

    def write(item) -> tuple[str, str]:
        name, spec = item
        path = f"{silver_root.rstrip('/')}/{spec.table}"
        for _ in range(snapshots.ATTEMPTS):
            base = snapshots.begin(spark, path)
            batch = f"{REFRESH_BATCH}-{snapshots.fresh_id()}"
            folder = f"_batch={batch}/_try=0"
            silver.build(bronze.read(spark, bronze_path), name).write.mode("overwrite").parquet(f"{path}/{folder}")
            rows = spark.read.schema(silver.table_schema(spec)).parquet(f"{path}/{folder}")
            entries = [snapshots.Entry(folder, stream=REFRESH_BATCH, batch=batch), id_segment(spark, path, rows, batch, REFRESH_BATCH)]
            try:
                mark = (progress or {}).get(name, {})
                snapshots.publish(spark, path, lambda v: replace(
                    snapshots.swapping(_untouched(v, base), list(base.entries), entries), progress=v.progress | mark))
                return name, path
            except snapshots.Overtaken:
                continue
        raise snapshots.Overtaken(path)

    with shuffles_dropped(spark), ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return dict(pool.map(write, [(n, s) for n, s in C.SILVER_SPECS.items() if names is None or n in names]))


def _untouched(now: snapshots.Snapshot, base: snapshots.Snapshot) -> snapshots.Snapshot:
    if now.version != base.version:
        raise snapshots.Overtaken(now.root)
    return now


def refresh_auto(
    spark: SparkSession, bronze_path: str, silver_root: str, full_above: float = 0.5, threads: int = 4
) -> dict[str, dict]:
    """Bring Silver up to date in the cheaper way (T02, ``REFRESH_MODE = AUTO``).

    Per table, the stored bytes of its event type in loads that it hasn't read are measured against those in all
    of Bronze: up to the share ``full_above`` the new loads alone are applied
    (``upkeep_batch``), above it, or for a table that was never written, the table is rebuilt. Both end in the same
    rows. Nothing is read to decide: sizes come from the file system. The choice, its bytes
    and the Bronze version reached are published with the table (``progress["auto"]``) and returned by table.
    """
    bronze_now = snapshots.current(spark, bronze_path)

    def size(entries: list[snapshots.Entry], spec) -> int:
        total = 0
        for e in entries:
            fs, folder = snapshots.file_system(spark, f"{bronze_now.root}/{e.folder}/_event_type={spec.event_type}")
            total += fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0
        return total

    def plan(item) -> tuple[str, dict]:
        name, spec = item
        mine = snapshots.current(spark, f"{silver_root.rstrip('/')}/{spec.table}")
        after = mine.progress.get("auto", {}).get("to", -1)
        new = size(unread_loads(bronze_now, after), spec)
        every = size(bronze_now.of(), spec)
        full = not mine.of() or new > full_above * every
        return name, {"mode": "full" if full else "incremental", "new_bytes": new, "all_bytes": every, "from": after, "to": bronze_now.version}

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        plans = dict(pool.map(plan, C.SILVER_SPECS.items()))
    rebuilt = [n for n, p in plans.items() if p["mode"] == "full"]
    if rebuilt:
        refresh_silver(spark, bronze_path, silver_root, threads, rebuilt, {n: {"auto": plans[n]} for n in rebuilt})
    for start in sorted({p["from"] for p in plans.values() if p["mode"] == "incremental"}):
        names = [n for n, p in plans.items() if p["mode"] == "incremental" and p["from"] == start]
        loads = unread_loads(bronze_now, start)
        if loads:
            upkeep_batch(bronze.read_entries(spark, bronze_now, loads), bronze_now.version, silver_root, names, threads=threads,
                         stream="auto", progress={n: {"auto": plans[n]} for n in names})
    return plans


def refresh_silver_bucketed(
    spark: SparkSession, bronze_path: str, database: str, buckets: int
) -> dict[str, str]:
    """E2 full refresh into catalog tables bucketed by their join key.

    Both order tables share ``buckets`` buckets on ``order_id`` and both
    customer tables on ``customer_id``, so the Gold aggregate + join on
    those keys reads co-partitioned data and plans with no exchange at all.
    The one shuffle (by key, ``buckets`` ways) is paid once per refresh
    instead of once per Gold build.

    Opt-in, for keys known not to be skewed: a bucket holding a hot key is
    read by one task, and AQE cannot split a bucketed scan. The default
    (``refresh_silver``) shuffles per build, where partial aggregation and
    AQE skew-join splitting absorb hot keys.
    """
    b = bronze.read(spark, bronze_path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = {}
    for name, spec in C.SILVER_SPECS.items():
        key = C.BUCKET_KEYS[name]
        table = f"{database}.{spec.table}"
        (
            silver.build(b, name)
            .repartition(buckets, key)
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, key)
            .saveAsTable(table)
        )
        out[name] = table
    return out


def build(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    calendar: tuple[str, str] = (C.CALENDAR_START, C.CALENDAR_END),
    audit: bool = True,
    threads: int = 4,
    env: str | None = None,
    custom_schema: str | None = None,
    require_pass: bool = False,
) -> DataFrame:
    """Write the Gold models, then run the declared tests over them.

    The tables go to folders of this build; when all are written and tested they become
    Gold's next version in one step, so a reader (``materialize.read_gold``) has all tables of one
    build or all of another. With ``require_pass`` a build with a failing
    test isn't published. With ``env`` (layer routing, S14) the catalog views
    ``<env>_gold.<model>`` (or ``<custom_schema>.<model>``) are pointed at the tables too.
    Tables of earlier builds stay until ``expire``.

    Returns the stored quality report ``(relation, column_name, test,
    failures)``.
    """
    w = Warehouse.from_tables(spark, silver_root, calendar_start=calendar[0], calendar_end=calendar[1])
    gold = gold_root.rstrip("/")
    folder = f"build-{snapshots.fresh_id()}"
    written: dict[str, str] = {}

    def write(name: str) -> str:
        path = f"{gold}/{folder}/{name}"
        materialize.write_table(w.model(name), path, audit=audit)
        return path

    for level in GOLD_LEVELS:
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            paths = dict(zip(level, pool.map(write, level)))
        written |= paths
        for name, path in paths.items():
            stored = spark.read.parquet(path)
            w.use(name, stored.drop("dbt_computed_at") if audit else stored)

    def rel(name: str) -> DataFrame:
        if name.startswith("dt_"):
            return w.silver[name[3:]]
        return w.model(name)

    report_path = f"{gold}/{folder}/{materialize.REPORT}"
    quality.run(rel).write.mode("overwrite").parquet(report_path)
    report = spark.read.parquet(report_path)
    if require_pass and not report.where("failures > 0").isEmpty():
        return report
    entries = [snapshots.Entry(f"{folder}/{name}", kind=name, batch=f"{folder}/{name}") for name in [*written, materialize.REPORT]]
    names = {e.kind for e in entries}
    snapshots.publish(spark, gold, lambda v: replace(v, entries=(*(e for e in v.entries if e.version and e.kind not in names), *entries)))
    if env:
        materialize.publish(spark, written, {
            name: materialize.qualify("gold", name, env, custom_schema) for name in written
        })
    return report
