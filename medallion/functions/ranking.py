"""Top-1-per-key helpers.

``keep_first`` is the ``QUALIFY ROW_NUMBER() ... = 1`` shape: Catalyst plans it
as a partial ``WindowGroupLimit`` before the exchange, so a key with millions of
copies reaches the shuffle as at most one row per map partition.

``latest_struct`` is the aggregate form used by the Gold models: instead of one
window plus one self-join per derived attribute, every "latest"/"first" value
of a key is one aggregate expression over a single ``groupBy``, which Spark
combines map-side (partial aggregation) before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, key: Sequence[str] | str, order: Sequence[Column]
) -> DataFrame:
    """Keep the first row per ``key`` under ``order`` (ascending, NULLS LAST)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def latest_struct(
    value: Column, order: Sequence[Column], where: Column | None = None
) -> Column:
    """Value of the row with the greatest ``order`` tuple (optionally filtered).

    ``max_by`` ignores rows whose ordering key is NULL; the ordering key here is
    a struct, which is never NULL, and NULL struct fields sort first, so a NULL
    timestamp loses to any real one (NULLS LAST under DESC).
    """
    ordering = F.struct(*order)
    if where is not None:
        ordering = F.when(where, ordering)
        value = F.when(where, value)
    return F.max_by(value, ordering)
