"""Incremental file ingest into Bronze (T01, T02; S04, S05 in a stream).

The file source lists new files under the landing prefix and records them in
the checkpoint, so each file is loaded once. It hands whole files to a
micro-batch, which is what makes the per-file reject gate exact inside
``foreachBatch``; ``maxFilesPerTrigger`` bounds the files per batch and hence
the size of the broadcast accepted-file list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion import snapshots
from medallion.contracts import MAX_BAD_RATIO
from medallion.operators import bronze, ledger
from medallion.sources.ndjson import read_files, stream_lines, stream_notifications

# Ledger of the files that notifications have brought into Bronze.
FILES = "files"


def load_id(stream: str, batch_id: int, prefix: str = "s") -> str:
    """Load ids carry the stream's own id: batches of two streams, or of one that was
    started again with a fresh checkpoint, never share one."""
    return f"{prefix}{stream}-{batch_id:012d}"


def start_bronze_stream(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = 1000,
    max_bad_ratio: str | float = MAX_BAD_RATIO,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    prefix: str = "s",
) -> StreamingQuery:
    """Start the landing -> Bronze stream; load ids are ``prefix``, stream and batch id.

    ``trigger`` defaults to ``{"processingTime": "1 minute"}``; use
    ``{"availableNow": True}`` for on-demand catch-up runs and tests.
    """
    lines = stream_lines(spark, landing_path, max_files_per_trigger, clean_source, archive_dir)
    stream = snapshots.stream_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        bronze.load_and_write(batch, bronze_path, load_id(stream, batch_id, prefix), max_bad_ratio=max_bad_ratio, stream=stream)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def start_ingest_stream(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    silver_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = 1000,
    max_bad_ratio: str | float = MAX_BAD_RATIO,
    horizon_days: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    quarantine: bool = False,
) -> StreamingQuery:
    """Landing -> Bronze -> Silver in ONE stream (chained upkeep).

    Each micro-batch writes its Bronze load, then keeps Silver up to date
    from exactly that load, read back from the load's own folder (lines are
    parsed once). The rest of Bronze isn't listed, which a second file-source
    stream over Bronze would do on every trigger.
    """
    from medallion.streaming.silver_stream import upkeep_batch

    lines = stream_lines(spark, landing_path, max_files_per_trigger, clean_source, archive_dir)
    stream = snapshots.stream_id(spark, checkpoint)

    def write(batch, batch_id: int) -> None:
        name = load_id(stream, batch_id)
        bronze.load_and_write(batch, bronze_path, name, max_bad_ratio=max_bad_ratio, stream=stream)
        loaded = bronze.read_load(spark, bronze_path, name)
        upkeep_batch(loaded, batch_id, silver_root, horizon_days=horizon_days, quarantine=quarantine, stream=stream)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def start_notified_stream(
    spark: SparkSession,
    notifications: str,
    landing_root: str,
    bronze_path: str,
    checkpoint: str,
    silver_root: str | None = None,
    trigger: dict | None = None,
    prefix: str = "events/",
    max_notifications_per_trigger: int = 1000,
    max_bad_ratio: str | float = MAX_BAD_RATIO,
    horizon_days: int | None = None,
    quarantine: bool = False,
) -> StreamingQuery:
    """Landing -> Bronze (-> Silver) driven by finalize notifications.

    A batch reads exactly the files that its notifications name, whatever the landing
    folder holds besides; no landing folder is listed. Notifications come at least once: the
    names of loaded files are kept in a ledger that is published with the load, so a file
    that is notified again, in the same batch or years later, isn't loaded again. The names
    of one batch, at most ``max_notifications_per_trigger`` files of them, pass through the driver as the scan's paths.
    """
    from medallion.streaming.silver_stream import merge_ids, segments_of, upkeep_batch

    stream = snapshots.stream_id(spark, checkpoint)
    root = bronze_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        name = load_id(stream, batch_id, "n")
        base = snapshots.begin(spark, root)
        names = batch.select(F.col("name").alias("event_id")).distinct().persist()
        try:
            seen, passed = ledger.known(names, segments_of([e for e in base.of(FILES) if e.batch != name], root))
            fresh = names if seen is None else names.join(seen, F.col("event_id") == F.col("_known"), "left_anti")
            paths = sorted(r[0] for r in fresh.collect())
            if passed is not None:
                passed.unpersist()
        finally:
            names.unpersist()
        if not paths:
            return
        folder = f"_{FILES}/{name}-{snapshots.fresh_id()}"
        shape = ledger.write_segment(spark.createDataFrame([(p,) for p in paths], "event_id string"), f"{root}/{folder}", len(paths))
        segment = snapshots.Entry(folder, FILES, stream, name, info=shape)
        lines = read_files(spark, [f"{landing_root.rstrip('/')}/{p}" for p in paths])
        bronze.load_and_write(lines, root, name, max_bad_ratio=max_bad_ratio, stream=stream, extra=[segment])
        merge_ids(spark, root, FILES)
        if silver_root:
            loaded = bronze.read_load(spark, root, name)
            upkeep_batch(loaded, batch_id, silver_root, horizon_days=horizon_days, quarantine=quarantine, stream=stream)

    source = stream_notifications(spark, notifications, prefix, max_notifications_per_trigger)
    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
