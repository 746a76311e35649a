"""NDJSON event files.

Files are read as text, never with ``spark.read.json``: schema inference would
type the payload, while Bronze is schema-on-read (one VARIANT per line). The
lines frame ``(value, _source_file)`` is what the Bronze gate consumes.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import snapshots

# File names of the landing contract (fixed value): time of publishing in UTC, 8 random hex digits.
FILE_NAME = "events-{at:%Y%m%d-%H%M%S}-{random}.ndjson"
NOTIFICATION_SCHEMA = "name string, size string, eventType string"
FINALIZED = "OBJECT_FINALIZE"

LINES_SCHEMA = "value string"


def _with_file(df: DataFrame) -> DataFrame:
    # _metadata.file_path works in batch and in the file-source stream.
    return df.select("value", F.col("_metadata.file_path").alias("_source_file"))


def read_lines(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Batch read of every NDJSON file under ``path`` (gzip etc. by extension)."""
    reader = spark.read.format("text").option("recursiveFileLookup", str(recursive).lower())
    return _with_file(reader.load(path))


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Incremental read: each new file is picked up once (checkpointed).

    ``clean_source`` (``"archive"`` with ``archive_dir``, or ``"delete"``)
    moves fully processed files out of the landing prefix, so the listing the
    file source repeats every trigger stays proportional to the backlog, not
    to everything ever landed.
    """
    reader = (
        spark.readStream.format("text")
        .schema(LINES_SCHEMA)
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return _with_file(reader.load(path))


def iso_utc(ts_ntz):
    """``YYYY-MM-DDTHH:MM:SSZ`` from a TIMESTAMP_NTZ holding UTC wall-clock time
    (F20). Built from the wall-clock fields, so the session time zone plays no
    part (``date_format`` would route the value through it): cut out of the value's
    own text, for years that aren't four digits (or null) formatted field by field."""
    text = ts_ntz.cast("string")
    cut = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z"))
    fields = F.format_string(
        "%04d-%02d-%02dT%02d:%02d:%02dZ",
        F.year(ts_ntz), F.month(ts_ntz), F.dayofmonth(ts_ntz),
        F.hour(ts_ntz), F.minute(ts_ntz), F.second(ts_ntz),
    )
    return F.when(F.year(ts_ntz).between(0, 9999), cut).otherwise(fields)


def envelope_json(
    event_id, event_type, event_ts, payload, version: str = "1.0"
):
    """One compact envelope JSON string column (``to_json`` is compact).

    ``event_ts`` is a TIMESTAMP_NTZ in UTC, written with ``EVENT_TS_FORMAT``
    semantics (seconds, ``Z`` suffix).
    """
    return F.to_json(
        F.struct(
            event_id.alias("event_id"),
            event_type.alias("event_type"),
            iso_utc(event_ts).alias("event_timestamp"),
            F.lit(version).alias("event_version"),
            payload.alias("payload"),
        )
    )


def write_ndjson(
    events: DataFrame,
    path: str,
    value_col: str = "value",
    compression: str | None = None,
    mode: str = "append",
) -> str:
    """NDJSON sink (S07): one compact JSON value per line under ``path``.

    ``events`` holds one JSON string per row in ``value_col`` (build it with
    ``envelope_json`` or ``to_json(struct(...))``). An empty input raises
    ``ValueError``, as publishing nothing is a caller error. Spark chooses the
    part-file names; the caller chooses the ``events/`` prefix via ``path``.
    """
    if events.isEmpty():
        raise ValueError("no events to publish")
    writer = events.select(F.col(value_col).alias("value")).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path


def publish_events(
    events: DataFrame,
    landing: str,
    prefix: str = "events/",
    value_col: str = "value",
    notify: str | None = None,
    at: dt.datetime | None = None,
    threads: int = 16,
) -> list[str]:
    """NDJSON sink with the landing contract's file names.

    Spark writes the lines into a hidden folder; once that job has committed, each of its files is renamed to
    ``<landing>/<prefix>events-YYYYMMDD-HHMMSS-<8 hex>.ndjson``, so a file is there whole or not at all, and
    a job that fails publishes nothing. Names never overwrite. Files without lines
    aren't published; without any line it is a ``ValueError``. With ``notify`` a finalize notification
    of each file is put into that folder, as a bucket would send it. Returns the published
    paths: one for each task that had lines.
    """
    spark = events.sparkSession
    root = landing.rstrip("/")
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    events.select(F.col(value_col).alias("value")).where(F.col("value").isNotNull()).write.text(staged)
    fs, folder = snapshots.file_system(spark, staged)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    parts = [(st.getPath(), st.getLen()) for st in fs.listStatus(folder) if st.getPath().getName().startswith("part-") and st.getLen()]
    if not parts:
        fs.delete(folder, True)
        raise ValueError("no events to publish")
    when = at or dt.datetime.now(dt.timezone.utc)
    fs.mkdirs(path(f"{root}/{prefix}x").getParent())

    def publish(part) -> str:
        source, size = part
        while True:
            name = prefix + FILE_NAME.format(at=when, random=uuid.uuid4().hex[:8])
            if snapshots.moved(spark, source, path(f"{root}/{name}")):
                break
        if notify:
            text = json.dumps({"name": name, "size": str(size), "eventType": FINALIZED})
            snapshots.create_text(spark, f"{notify.rstrip('/')}/{uuid.uuid4().hex}.json", text)
        return f"{root}/{name}"

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        out = sorted(pool.map(publish, parts))
    fs.delete(folder, True)
    return out


def stream_notifications(spark: SparkSession, path: str, prefix: str = "events/", max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Names of newly landed objects, from finalize notifications (one JSON object a line)
    that a bucket's subscription puts into ``path``; others, and names elsewhere than under ``prefix``, are left out."""
    reader = spark.readStream.format("text").schema(LINES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    sent = reader.load(path).select(F.from_json("value", NOTIFICATION_SCHEMA).alias("n")).select("n.*")
    return sent.where((F.col("eventType") == FINALIZED) & F.startswith(F.col("name"), F.lit(prefix))).select("name")


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of exactly these files; no folder is listed."""
    return _with_file(spark.read.format("text").load(paths))
