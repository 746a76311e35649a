"""Bounded Arrow blocks and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from medallion.session import checkpoint_root

#: Rows and bytes of text that the JVM hands over at once; long texts go alone.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def configure(spark: SparkSession) -> None:
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)


def blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def map_blocks(
    df: DataFrame, column: str, max_bytes: int, make: Callable, schema: str
) -> DataFrame:
    """``mapInArrow`` over bounded blocks; ``make()`` gives each task its function of a block."""
    configure(df.sparkSession)

    def run(batches):
        each = make()
        for block in blocks(batches, column, max_bytes):
            yield from each(block)

    return df.mapInArrow(run, schema)


#: Spark removes a query's shuffle files as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Later steps read the files, so the shuffles of the write are dropped with it and don't
    wait on disk for the driver's garbage collection."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
