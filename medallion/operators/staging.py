"""Staging views (D06-D09; P03, S12): rename-only projections of Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.contracts import STAGING_COLUMNS


def stage(silver: DataFrame, name: str) -> DataFrame:
    return silver.select(*[F.col(src).alias(dst) for src, dst in STAGING_COLUMNS[name]])
