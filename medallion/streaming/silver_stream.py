"""Silver upkeep from the Bronze table.

Keep-first by ``event_id`` is monotone over append-only Bronze: a later
delivery never changes the answer. So each micro-batch is

1. extract + keep-first *within* the batch (exact: earliest ``_ingested_at``),
2. left-anti join against the event ids that the table has taken in,
3. the survivors, in a folder of their own, and their ids, published together as one version.

Step 2 asks the table's id ledger (``operators.ledger``), which reads the Bloom
filters of the buckets that the batch's ids fall in and the few buckets that may hold one,
so a batch costs about the same on a table of any size and is exact for any delay. With
``horizon_days`` set, segments of the ledger whose newest row is older than that before
the batch are left out; a redelivery after that may be appended again.

Folders and ledger entries are named by stream and batch. A replayed batch takes the place
of its own entries, streams don't touch each other's, and of two streams that publish at
once the second looks up the ids of the first before it does.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion import snapshots
from medallion.contracts import SILVER_SPECS
from medallion.operators import bronze, ledger, silver
from medallion.session import shuffles_dropped

# Suffix of the folder that holds a table's rows with values that fail their cast.
QUARANTINE = "_quarantine"
IDS = "ids"


def batch_tag(batch_id: int, stream: str | None = None) -> str:
    return f"{stream}-{batch_id:012d}" if stream else f"{batch_id:012d}"


def segments_of(entries: list[snapshots.Entry], root: str, since: str | None = None) -> list[tuple[str, dict]]:
    """What ``ledger.known`` takes, of a version's ledger entries."""
    return [(f"{root}/{e.folder}", e.info) for e in entries if since is None or (e.info.get("until") or since) >= since]


def id_segment(
    spark: SparkSession, root: str, rows: DataFrame, tag: str, stream: str | None = None, measured: tuple | None = None
) -> snapshots.Entry:
    """A ledger segment of the stored ``rows`` (their ids are read back, one column);
    ``measured``: their newest load time and their number, where known."""
    folder = f"_{IDS}/{tag}-{snapshots.fresh_id()}"
    until, count = measured or rows.agg(F.max("_ingested_at"), F.count(F.lit(1))).first()
    shape = ledger.write_segment(rows.select("event_id"), f"{root}/{folder}", count)
    return snapshots.Entry(folder, IDS, stream, tag, info=shape | {"until": until and until.isoformat()})


def _adopt(spark: SparkSession, target: str, name: str) -> snapshots.Snapshot:
    """The table's newest version, with a ledger also for rows stored before it had one."""
    now = snapshots.begin(spark, target)
    old = [e for e in now.of() if not e.version]
    if not old or "adopted" in now.progress:
        return now
    rows = silver.read_table(spark, target.rsplit("/", 1)[0], name, replace(now, entries=tuple(old)))
    segment = id_segment(spark, target, rows.select("event_id", "_ingested_at").distinct(), "adopted")

    def change(newest: snapshots.Snapshot) -> snapshots.Snapshot:
        if "adopted" in newest.progress:
            raise snapshots.Overtaken(target)
        return replace(newest, entries=(*newest.entries, segment), progress=newest.progress | {"adopted": True})

    try:
        return snapshots.publish(spark, target, change)
    except snapshots.Overtaken:
        return snapshots.current(spark, target)


def merge_ids(spark: SparkSession, target: str, kind: str = IDS) -> int:
    """Merge segments of the ledger that are due; returns how many went. The newest
    segment of each stream stays, as its batch may be replayed."""
    now = snapshots.current(spark, target)
    newest = {e.stream: e for e in now.of(kind)}
    done = 0
    loose = [e for e in now.of(kind) if newest[e.stream] is not e]
    for group in ledger.due([e.info["ids"] for e in loose]):
        old = [loose[i] for i in group]
        folder = f"_{kind}/m-{snapshots.fresh_id()}"
        shape = ledger.merged(spark, segments_of(old, target), f"{target}/{folder}")
        until = max((e.info.get("until") or "" for e in old), default="")
        merged = snapshots.Entry(folder, kind, "merged", folder, info=shape | {"until": until or None})
        try:
            snapshots.publish(spark, target, lambda v: snapshots.swapping(v, old, [merged]))
        except snapshots.Overtaken:
            continue  # another writer has merged some of them
        done += len(old)
    return done


def _upkeep_one(
    batch: DataFrame, tag: str, silver_root: str, name: str, since: str | None, quarantine: bool = False,
    stream: str | None = None, progress: dict | None = None, evict: bool = False,
) -> None:
    spark = batch.sparkSession
    spec = SILVER_SPECS[name]
    target = f"{silver_root.rstrip('/')}/{spec.table}"
    if quarantine:
        bad = silver.quarantine(batch, spec)
        folder = f"_batch={tag}/_try={snapshots.fresh_id()}"
        snapshots.begin(spark, f"{target}{QUARANTINE}")
        bad.write.mode("overwrite").parquet(f"{target}{QUARANTINE}/{folder}")
        aside = snapshots.Entry(folder, stream=stream, batch=tag)
        snapshots.publish(spark, f"{target}{QUARANTINE}", lambda now: snapshots.replacing(now, stream, tag, [aside]))
        typed = silver.extract_castable(batch, spec)
    else:
        typed = silver.extract(batch, spec)
    rows = silver.dedupe(typed)
    kept = False
    try:
        for _ in range(snapshots.ATTEMPTS):
            base = _adopt(spark, target, name)
            own = [e for e in base.entries if e.batch == tag]
            if len(own) == 1:
                return  # its rows or its ids are part of a compaction: taken in for good
            segments = segments_of([e for e in base.of(IDS) if e.batch != tag], target, since)
            if not kept and any(info["ids"] for _, info in segments):
                rows.persist(StorageLevel.MEMORY_AND_DISK)  # looked up, then written; otherwise they are read once
                kept = True
            fresh, passed = _without_known(rows, segments)
            folder = f"_batch={tag}/_try={snapshots.fresh_id()}"
            taken = Observation()  # newest load time and number of the rows, as they are written
            fresh = fresh.observe(taken, F.max("_ingested_at").alias("until"), F.count(F.lit(1)).alias("n"))
            fresh.write.mode("overwrite").parquet(f"{target}/{folder}")
            if passed is not None:
                passed.unpersist()
            written = spark.read.schema(silver.table_schema(spec)).parquet(f"{target}/{folder}")
            measured = (taken.get["until"], taken.get["n"])
            entries = [snapshots.Entry(folder, stream=stream, batch=tag), id_segment(spark, target, written, tag, stream, measured)]

            def change(now: snapshots.Snapshot) -> snapshots.Snapshot:
                before = {e.folder for e in base.of(IDS)}
                if any(e.folder not in before for e in now.of(IDS)):
                    raise snapshots.Overtaken(target)  # ids that this batch hasn't been compared with
                after = snapshots.replacing(now, stream, tag, entries)
                left = after.entries
                if evict and since is not None:
                    left = tuple(e for e in left if e.kind != IDS or e.batch == tag or (e.info.get("until") or since) >= since)
                return replace(after, entries=left, progress=now.progress | (progress or {}))

            try:
                snapshots.publish(spark, target, change)
                break
            except snapshots.Overtaken:
                continue
        else:
            raise snapshots.Overtaken(target)
    finally:
        if kept:
            rows.unpersist()
    merge_ids(spark, target)


def _without_known(fresh: DataFrame, segments: list[tuple[str, dict]]) -> tuple[DataFrame, DataFrame | None]:
    """``fresh`` without the ids in the ledger's segments, null-safe; and what to release."""
    known, passed = ledger.known(fresh.select("event_id"), segments)
    if known is None:
        return fresh, passed
    return fresh.join(known, F.col("event_id").eqNullSafe(F.col("_known")), "left_anti"), passed


def upkeep_batch(
    batch: DataFrame,
    batch_id: int,
    silver_root: str,
    names=None,
    horizon_days: int | None = None,
    threads: int = 4,
    quarantine: bool = False,
    stream: str | None = None,
    progress: dict[str, dict] | None = None,
    evict: bool = False,
) -> None:
    """Apply one Bronze micro-batch to the Silver tables.

    ``stream`` names the stream whose batch it is (``snapshots.stream_id``). A batch
    that is applied again takes the place of its earlier rows. ``progress`` is published
    with a table's rows, by table. ``evict`` drops the ledger's segments beyond ``horizon_days``.

    A value that fails its cast stops the batch; with ``quarantine`` its row is
    written to the table's quarantine folder instead and the other rows go on.

    The tables are independent, so their jobs are submitted concurrently
    (``threads``); each reads only its event type's Bronze partition.
    """
    tag = batch_tag(batch_id, stream)
    since = None
    if horizon_days is not None:
        # one scalar per batch: the earliest load time it contains
        lo = batch.agg(F.min("_ingested_at")).first()[0]
        if lo is not None:
            since = (lo - dt.timedelta(days=horizon_days)).date().isoformat()
    todo = list(names or SILVER_SPECS)

    def one(n: str) -> None:
        _upkeep_one(batch, tag, silver_root, n, since, quarantine, stream, (progress or {}).get(n), evict)

    with shuffles_dropped(batch.sparkSession):
        if threads > 1 and len(todo) > 1:
            with ThreadPoolExecutor(max_workers=min(threads, len(todo))) as pool:
                for f in [pool.submit(one, n) for n in todo]:
                    f.result()
        else:
            for n in todo:
                one(n)


def unread_loads(bronze_now: snapshots.Snapshot, after: int) -> list[snapshots.Entry]:
    """Bronze folders with loads that were published after version ``after``; a compaction
    only if it holds one of them."""
    return [e for e in bronze_now.of() if e.info.get("covers", e.version) > after]


def start_silver_stream(
    spark: SparkSession,
    bronze_path: str,
    silver_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    names=None,
    horizon_days: int | None = None,
    max_files_per_trigger: int | None = None,
    evict: bool = False,
) -> StreamingQuery:
    """Start Bronze -> Silver upkeep (default trigger: the 5 minute lag target).

    The stream watches Bronze's versions, one small file a load, and reads the folders of
    exactly the loads that its Silver tables haven't taken in; the rest of Bronze isn't listed.
    Each table's version says up to which Bronze version it has read, so expired
    versions, replays and tables that are ahead of others are all the same to it.
    ``max_files_per_trigger`` bounds the versions that wake it at once.
    """
    versions = f"{bronze_path.rstrip('/')}/{snapshots.VERSIONS}"
    fs, folder = snapshots.file_system(spark, versions)
    fs.mkdirs(folder)
    reader = spark.readStream.schema("value string").option("pathGlobFilter", "v*.json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.text(versions)
    stream = snapshots.stream_id(spark, checkpoint)
    todo = list(names or SILVER_SPECS)

    def write(batch: DataFrame, batch_id: int) -> None:
        now = snapshots.current(spark, bronze_path)
        starts: dict[str, int] = {}
        for n in todo:
            mine = snapshots.current(spark, f"{silver_root.rstrip('/')}/{SILVER_SPECS[n].table}").progress.get(stream, {})
            # a replayed batch starts where it did the first time
            starts[n] = mine.get("from" if mine.get("batch") == batch_id else "to", -1)
        for start in sorted(set(starts.values())):
            loads = unread_loads(now, start)
            if not loads:
                continue
            tables = [n for n in todo if starts[n] == start]
            progress = {n: {stream: {"batch": batch_id, "from": start, "to": now.version}} for n in tables}
            upkeep_batch(bronze.read_entries(spark, now, loads), batch_id, silver_root, tables, horizon_days, stream=stream, progress=progress, evict=evict)

    return (
        src.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 minutes"}))
        .start()
    )


def read_silver(spark: SparkSession, silver_root: str, name: str) -> DataFrame:
    """A stream-maintained Silver table with its logical columns only."""
    return silver.read_table(spark, silver_root, name)


def read_quarantine(spark: SparkSession, silver_root: str, name: str) -> DataFrame:
    """The rows of a table's type that were set aside, each batch's last attempt."""
    root = f"{silver_root.rstrip('/')}/{SILVER_SPECS[name].table}{QUARANTINE}"
    return snapshots.read(spark, snapshots.current(spark, root), "raw_json string, _source_file string, _ingested_at timestamp_ntz")


def start_silver_stream_within_watermark(
    spark: SparkSession,
    bronze_path: str,
    silver_root: str,
    checkpoint: str,
    name: str,
    horizon_days: int = 7,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``start_silver_stream`` of one table with bounded state.

    Of the copies of an event in one batch the earliest is kept, as in a full refresh, and copies that
    come within ``horizon_days`` of load time after the first are dropped: the result is
    the full refresh's whenever redeliveries are no later than that (the queue's replay window).
    Segments of the id ledger that are older go with the batch that no longer needs them, so
    state and cost stay those of the horizon, not of the history; a copy later than that is appended again.
    """
    return start_silver_stream(spark, bronze_path, silver_root, checkpoint, trigger, [name], horizon_days, evict=True)
