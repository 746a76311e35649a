"""Materialization: views, tables, layer routing, audit column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import snapshots

# The stored data-test results of a Gold build.
REPORT = "_quality_report"
LAYERS = ("bronze", "silver", "gold")


def qualify(layer: str, name: str, env: str = "dev", custom_schema: str | None = None) -> str:
    """Layer routing (S14): ``<env>_<layer>.<name>``; a custom schema name is
    used trimmed, with no prefix, as the source project's routing macro does."""
    custom = (custom_schema or "").strip()
    if layer not in LAYERS and not custom:
        raise ValueError(f"unknown layer {layer!r}")
    schema = custom or f"{env}_{layer}"
    return f"{schema}.{name}"


def with_audit(df: DataFrame, column: str = "dbt_computed_at") -> DataFrame:
    """Add the build-time audit column."""
    return df.withColumn(column, F.current_timestamp().cast("timestamp_ntz"))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Materialize as view (S12): a named lazy plan, recomputed on read."""
    df.createOrReplaceTempView(name)
    return df


def write_table(
    df: DataFrame,
    path: str,
    audit: bool = False,
    partition_by: list[str] | None = None,
) -> None:
    """Materialize as table (S13): full replace of the table at ``path``."""
    out = with_audit(df) if audit else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_as_table(df: DataFrame, qualified: str, audit: bool = False) -> None:
    """Catalog variant of ``write_table`` (``CREATE OR REPLACE`` semantics)."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified.split('.')[0]}")
    out = with_audit(df) if audit else df
    out.write.mode("overwrite").format("parquet").saveAsTable(qualified)


def publish(spark: SparkSession, paths: dict[str, str], qualified: dict[str, str]) -> None:
    """Point the catalog views ``qualified[name]`` at the tables stored in ``paths``.

    Each view is replaced in one catalog operation, so a reader sees a table's
    old rows or its new ones, never a folder that is being written. The catalog
    has to outlive the session (a metastore) for other sessions to see them.
    """
    for name, path in paths.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified[name].split('.')[0]}")
        spark.sql(f"CREATE OR REPLACE VIEW {qualified[name]} AS SELECT * FROM parquet.`{path}`")


def read_gold(spark: SparkSession, gold_root: str, name: str, snapshot: snapshots.Snapshot | None = None) -> DataFrame:
    """A Gold table of the newest build, or of the version ``snapshot`` (which makes
    several tables come from one build)."""
    now = snapshot or snapshots.current(spark, gold_root)
    paths = now.paths(name)
    if not paths:
        raise KeyError(f"{gold_root}: no table {name!r} in version {now.version}")
    return spark.read.parquet(*paths)
