"""Silver tables (D02-D05; P01, P02, P05, W01, S15).

``extract`` cuts one event type out of Bronze and types its fields;
``dedupe`` keeps the first delivery of every ``event_id`` (earliest
``_ingested_at``; ties broken by source file, then by the typed values, so the
result is deterministic). Catalyst pushes the event-type filter and the
variant paths into the Bronze scan, and plans the keep-first as a partial
``WindowGroupLimit`` before a single exchange on ``event_id``: even an
``event_id`` redelivered millions of times reaches the shuffle as at most one
row per map partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion import snapshots
from medallion.contracts import SILVER_SPECS, Field, SilverSpec
from medallion.functions.ranking import keep_first


def _extract(raw: Column, f: Field, strict: bool) -> Column:
    get = F.variant_get if strict else F.try_variant_get
    if f.type == "int":
        # The warehouse rounds when casting a number to INT (3.7 -> 4).
        return F.round(get(raw, f.path, "decimal(38,6)"), 0).cast("int")
    return get(raw, f.path, f.type)


def extract(bronze: DataFrame, spec: SilverSpec | str, strict: bool = True) -> DataFrame:
    """Typed rows of one event type; ``strict`` makes a failed cast abort."""
    if isinstance(spec, str):
        spec = SILVER_SPECS[spec]
    raw = F.col("raw_data")
    df = bronze
    if "_event_type" in bronze.columns:  # directory pruning on written Bronze
        df = df.where(F.col("_event_type") == spec.event_type)
    df = df.where(F.try_variant_get(raw, "$.event_type", "string") == spec.event_type)
    cols = [_extract(raw, f, strict).alias(f.name) for f in spec.fields]
    return df.select(*cols, "_source_file", "_ingested_at")


def table_schema(spec: SilverSpec) -> str:
    """Declared columns of a stored Silver table: reading one infers nothing from
    its files, and a table without rows is read like any other."""
    return ", ".join([f"{f.name} {f.type}" for f in spec.fields] + ["_source_file string", "_ingested_at timestamp_ntz"])


def read_table(spark, silver_root: str, name: str, snapshot: snapshots.Snapshot | None = None) -> DataFrame:
    """A stored Silver table's logical columns: the rows of one version, the newest
    unless another is given."""
    spec = SILVER_SPECS[name]
    root = f"{silver_root.rstrip('/')}/{spec.table}"
    now = snapshot or snapshots.current(spark, root)
    if not now.version and not now.entries:
        raise FileNotFoundError(f"{root}: nothing has been written")
    return snapshots.read(spark, now, table_schema(spec)).select(*spec.columns)


def dedupe(typed: DataFrame) -> DataFrame:
    """Keep-first per ``event_id``."""
    order = [F.col("_ingested_at").asc_nulls_last(), F.col("_source_file").asc_nulls_last()]
    order += [
        F.col(c).asc_nulls_last()
        for c in typed.columns
        if c not in ("event_id", "_ingested_at", "_source_file")
    ]
    return keep_first(typed, "event_id", order)


def build(bronze: DataFrame, name: str, strict: bool = True) -> DataFrame:
    """One Silver table from (all of) Bronze: the full-refresh form."""
    return dedupe(extract(bronze, name, strict))


def build_all(bronze: DataFrame, strict: bool = True) -> dict[str, DataFrame]:
    return {name: build(bronze, name, strict) for name in SILVER_SPECS}


def _uncastable(raw: Column, spec: SilverSpec) -> Column:
    """TRUE when a field of ``spec`` is present but fails its strict cast."""
    present_but_bad = F.lit(False)
    for f in spec.fields:
        v = F.try_variant_get(raw, f.path, "variant")
        present_but_bad = present_but_bad | (
            v.isNotNull()
            & ~F.is_variant_null(v)
            & _extract(raw, f, strict=False).isNull()
        )
    return F.coalesce(present_but_bad, F.lit(False))


def extract_castable(bronze: DataFrame, spec: SilverSpec | str) -> DataFrame:
    """Typed rows of one event type without those that ``quarantine`` returns."""
    if isinstance(spec, str):
        spec = SILVER_SPECS[spec]
    return extract(bronze.where(~_uncastable(F.col("raw_data"), spec)), spec, strict=False)


def quarantine(bronze: DataFrame, spec: SilverSpec | str) -> DataFrame:
    """Bronze rows of ``spec``'s type whose fields fail the strict cast."""
    if isinstance(spec, str):
        spec = SILVER_SPECS[spec]
    raw = F.col("raw_data")
    if "_event_type" in bronze.columns:
        bronze = bronze.where(F.col("_event_type") == spec.event_type)
    df = bronze.where(F.try_variant_get(raw, "$.event_type", "string") == spec.event_type)
    return df.where(_uncastable(raw, spec)).select(
        F.to_json(raw).alias("raw_json"), "_source_file", "_ingested_at"
    )
