"""CSV seed scan (S08, D12): versioned CSV with declared column types."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from medallion.contracts import PRODUCT_SCHEMA

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"
PRODUCTS_CSV = SEED_DIR / "dim_products.csv"


def read_seed(spark: SparkSession, path: str | Path, schema: str) -> DataFrame:
    """Header CSV with an explicit schema; any malformed row fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .csv(str(path))
    )


def dim_products(spark: SparkSession, path: str | Path = PRODUCTS_CSV) -> DataFrame:
    """Product dimension straight from the seed file (20 rows, joined by nothing)."""
    return read_seed(spark, path, PRODUCT_SCHEMA)
