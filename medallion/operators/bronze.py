"""Bronze load (D01; S01, S01b, S03, S05, S06).

Lines ``(value, _source_file)`` -> ``(raw_data VARIANT, _source_file,
_ingested_at)``. A line is *good* when it is valid UTF-8 and holds exactly one
JSON value that parses without duplicate keys. A file whose share of bad
lines exceeds ``max_bad_ratio`` is skipped whole; otherwise its good lines
are loaded and its bad lines dropped.

``load_and_write`` stages the parsed lines, counts from what it stored and
publishes the load in one step. ``load`` and ``gate`` are the lazy form:

Scale: the per-file statistics are one grouped aggregate (partial
aggregation map-side, so a file holding a third of all lines costs nothing
extra). The gate is then a left-semi join of the lines with the accepted
files. When the caller knows how many files the input has (a file listing or
a stream's ``maxFilesPerTrigger``) and it is below ``BROADCAST_FILES``, the
file list is broadcast and the lines are never shuffled; otherwise
the accepted-file list is resolved (and counted) first, then broadcast when
small; only a list too large to broadcast leads to a shuffled semi-join,
whose skewed partitions AQE splits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion import snapshots
from medallion.contracts import MAX_BAD_RATIO, SILVER_SPECS
from medallion.session import shuffles_dropped

KNOWN_EVENT_TYPES = [spec.event_type for spec in SILVER_SPECS.values()]
OTHER_EVENT_TYPE = "_other"
# Folder of the lines that don't parse, in a staged load only.
BAD_LINES = "_bad"

# Largest number of files whose accepted-file list we broadcast by hint
# (~100 bytes per path: 200k files is ~20 MB).
BROADCAST_FILES = 200_000


def good_json(value: Column) -> Column:
    """TRUE when ``value`` is one well-formed JSON value (S01b), as the only element of an array.

    What follows the closing bracket isn't looked at. Only a line that holds one itself could end the
    array early; such lines, and they alone, must parse as an object's member too.
    """
    one_value = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    nothing_after = F.json_object_keys(F.concat(F.lit('{"x":'), value, F.lit("}"))).isNotNull()
    return F.coalesce(F.is_valid_utf8(value) & one_value & (~F.contains(value, F.lit("]")) | nothing_after), F.lit(False))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines; add ``raw_data`` (NULL for a bad line) and ``_bad``.

    Parsing is the costliest step of the pipeline, so each line is parsed
    once per plan branch. The parsed value is emitted by a generator
    (``inline``): a filter on a generator's output is not rewritten into the
    generator's input, whereas through a plain projection Catalyst would
    inline the parse into every predicate on ``raw_data`` and parse the line
    again for each of them. The test for blank lines stands behind the generator too,
    so that a line that is itself computed (rendered, decoded) is computed once.
    """
    value = F.col("value")
    raw = F.when(good_json(value), F.try_parse_json(value))
    blank = F.length(F.trim(value)) == 0
    parsed = lines.select(F.inline(F.array(F.struct(F.col("_source_file"), raw.alias("raw_data"), blank.alias("_blank")))))
    parsed = parsed.where(~F.col("_blank")).drop("_blank")
    return parsed.withColumn("_bad", F.col("raw_data").isNull())


def file_report(parsed: DataFrame, max_bad_ratio: str | float = MAX_BAD_RATIO) -> DataFrame:
    """Per-file gate decision: lines, bad lines, bad share, loaded flag."""
    stats = parsed.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col("_bad")).alias("bad_lines"),
    )
    return _judged(stats, max_bad_ratio)


def _judged(stats: DataFrame, max_bad_ratio: str | float) -> DataFrame:
    limit = F.lit(Decimal(str(max_bad_ratio))).cast("decimal(10,6)")
    return stats.select(
        "_source_file",
        "total_lines",
        "bad_lines",
        (F.col("bad_lines").cast("double") / F.col("total_lines").cast("double")).alias("bad_ratio"),
        # exact decimal compare: skip when bad > ratio * total
        (~(F.col("bad_lines").cast("decimal(20,0)") > limit * F.col("total_lines").cast("decimal(20,0)"))).alias("loaded"),
    )


def load(
    lines: DataFrame,
    ingested_at: Column | str | None = None,
    max_bad_ratio: str | float = MAX_BAD_RATIO,
    max_files: int | None = None,
) -> DataFrame:
    """Bronze rows for one load of ``lines`` (lazy; see ``gate``)."""
    return gate(parse_lines(lines), ingested_at, max_bad_ratio, max_files)


def gate(
    parsed: DataFrame,
    ingested_at: Column | str | None = None,
    max_bad_ratio: str | float = MAX_BAD_RATIO,
    max_files: int | None = None,
) -> DataFrame:
    """Apply the per-file reject gate to parsed lines (``parse_lines``).

    ``ingested_at`` defaults to the load's ``current_timestamp()``; pass a
    literal to replay a historical load reproducibly. ``max_files`` is an
    upper bound on distinct files in ``lines``, when known (a file listing, a
    stream's ``maxFilesPerTrigger``): below ``BROADCAST_FILES`` the accepted
    list is broadcast and the plan stays lazy.

    When no bound is known, the accepted-file list is resolved first: the
    per-file aggregate runs as its own small job, is cut from its lineage
    with a reliable ``checkpoint()`` (shared checkpoint folder) and counted,
    and is broadcast when that count is within ``BROADCAST_FILES``. Only a
    larger list falls back to a shuffled semi-join (which AQE de-skews).
    Either way the lines themselves are not shuffled unless the file list is
    genuinely too large to broadcast.
    """
    accepted = file_report(parsed, max_bad_ratio).where("loaded").select("_source_file")
    if max_files is None:
        accepted = _resolved(accepted)
        max_files = accepted.count()
    if max_files <= BROADCAST_FILES:
        accepted = F.broadcast(accepted)
    return (
        parsed.where(~F.col("_bad"))
        .join(accepted, "_source_file", "left_semi")
        .select("raw_data", "_source_file", _stamp(ingested_at).alias("_ingested_at"))
    )


def load_and_write(
    lines: DataFrame,
    path: str,
    load_id: str,
    ingested_at: Column | str | None = None,
    max_bad_ratio: str | float = MAX_BAD_RATIO,
    stream: str | None = None,
    extra: list[snapshots.Entry] | None = None,
) -> None:
    """Gate ``lines`` and publish them as load ``load_id``, parsing each line ONCE.

    The parsed lines are written once, to a staged folder of this attempt that no
    reader knows; a bad line is a row without a value in a folder of its own. The counts
    of the files come from two small columns of what is stored (the file's name and the
    folder). ``extra`` entries of the load (ledger segments) are published with it. The folders of event types then become the load as they are; only
    types with lines of a rejected file are copied without them, still without
    parsing. Nothing of the load is cached, and it is published in one step (``snapshots``).
    """
    spark = lines.sparkSession
    root, attempt = path.rstrip("/"), snapshots.fresh_id()
    snapshots.begin(spark, root)
    staged, folder = f"{root}/_staged/{attempt}", f"_load={load_id}/_try={attempt}"
    parsed = parse_lines(lines).select("raw_data", "_source_file", _stamp(ingested_at).alias("_ingested_at"))
    with shuffles_dropped(spark):
        _written(with_partition(parsed), staged)
    stored = spark.read.schema(STAGED_SCHEMA).parquet(staged)
    counts = _resolved(stored.groupBy("_source_file", "_event_type").agg(F.count(F.lit(1)).alias("lines")))
    stats = counts.groupBy("_source_file").agg(
        F.sum("lines").alias("total_lines"),
        F.sum(F.when(F.col("_event_type") == BAD_LINES, F.col("lines")).otherwise(0)).alias("bad_lines"),
    )
    rejected = _judged(stats, max_bad_ratio).where(~F.col("loaded")).select("_source_file")
    types = [r[0] for r in counts.select("_event_type").distinct().collect() if r[0] != BAD_LINES]
    mixed = {r[0] for r in counts.join(rejected, "_source_file", "left_semi").select("_event_type").distinct().collect()} & set(types)
    if mixed:
        files = rejected.count()
        good = stored.where(F.col("_event_type").isin(*mixed))
        good = good.join(F.broadcast(rejected) if files <= BROADCAST_FILES else rejected, "_source_file", "left_anti")
        _written(good, f"{root}/{folder}")
    fs, target = snapshots.file_system(spark, f"{root}/{folder}")
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(target)
    for name in set(types) - mixed:
        if not fs.rename(jvm_path(f"{staged}/_event_type={name}"), jvm_path(target, f"_event_type={name}")):
            raise OSError(f"{staged}/_event_type={name} could not be moved to {folder}")
    fs.delete(jvm_path(staged), True)
    _publish(spark, root, load_id, stream, folder, extra)


def _stamp(ingested_at: Column | str | None) -> Column:
    if ingested_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ingested_at, str):
        return F.lit(ingested_at).cast("timestamp_ntz")
    return ingested_at.cast("timestamp_ntz")


def _resolved(files: DataFrame) -> DataFrame:
    """A list of files, computed once (reliable checkpoint in the shared folder)."""
    from medallion.session import checkpoint_root

    checkpoint_root(files.sparkSession)
    return files.checkpoint(eager=True)


def _written(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_event_type").parquet(folder)


def _publish(spark, root: str, load_id: str, stream: str | None, folder: str, extra: list[snapshots.Entry] | None = None) -> None:
    entries = [snapshots.Entry(folder, stream=stream, batch=load_id), *(extra or ())]
    snapshots.publish(spark, root, lambda now: snapshots.replacing(now, stream, load_id, entries))


def event_type(raw: Column | str = "raw_data") -> Column:
    c = F.col(raw) if isinstance(raw, str) else raw
    return F.try_variant_get(c, "$.event_type", "string")


def with_partition(bronze: DataFrame) -> DataFrame:
    """Add the derived ``_event_type`` directory column used for pruning.

    Only the known domain types get their own directory; anything else
    (telemetry, garbage) goes to ``_other`` and lines without a value to ``_bad``, so
    the number of directories per load is bounded no matter what the producers send.
    """
    # read out of the value once, in a projection of its own
    typed = bronze.withColumn("_event_type", event_type())
    et = F.col("_event_type")
    known = F.coalesce(et.isin(*KNOWN_EVENT_TYPES), F.lit(False))
    kind = F.when(F.col("raw_data").isNull(), F.lit(BAD_LINES)).when(known, et).otherwise(F.lit(OTHER_EVENT_TYPE))
    return typed.withColumn("_event_type", kind)


# Physical Bronze table: the 3 logical columns plus directory columns: the load id
# (idempotent replays), the attempt that wrote it and the derived event type (pruning).
STAGED_SCHEMA = "raw_data variant, _source_file string, _ingested_at timestamp_ntz, _event_type string"
BRONZE_TABLE_SCHEMA = (
    "raw_data variant, _source_file string, _ingested_at timestamp_ntz, "
    "_load string, _try string, _event_type string"
)


def write_load(bronze: DataFrame, path: str, load_id: str, stream: str | None = None) -> None:
    """Write one load into Bronze.

    Bronze is append-only across loads; a load that is run again (a retried
    micro-batch) takes the place of its own earlier rows, in one step. A load id that
    another stream has used is refused.
    """
    root = path.rstrip("/")
    folder = f"_load={load_id}/_try={snapshots.fresh_id()}"
    snapshots.begin(bronze.sparkSession, root)
    _written(with_partition(bronze.where(F.col("raw_data").isNotNull())), f"{root}/{folder}")
    _publish(bronze.sparkSession, root, load_id, stream, folder)


def _live(spark, path: str) -> snapshots.Snapshot:
    now = snapshots.current(spark, path)
    if not now.version and not now.entries:
        raise FileNotFoundError(f"{path}: no load has been written")
    return now


def read(spark, path: str, snapshot: snapshots.Snapshot | None = None) -> DataFrame:
    """Bronze table as written by ``write_load`` (3 logical columns + 2 dirs): all
    loads of one version, the newest unless another is given."""
    return snapshots.read(spark, snapshot or _live(spark, path), BRONZE_TABLE_SCHEMA).drop("_try")


def read_load(spark, path: str, load_id: str) -> DataFrame:
    """One load of the Bronze table; only its own folder is listed."""
    now = _live(spark, path)
    return read_entries(spark, now, [e for e in now.of() if e.batch == load_id])


def read_entries(spark, snapshot: snapshots.Snapshot, entries: list[snapshots.Entry]) -> DataFrame:
    """Some loads of a version."""
    return snapshots.read(spark, snapshot, BRONZE_TABLE_SCHEMA, entries=entries).drop("_try")
