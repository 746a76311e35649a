"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(natural_key: Column | str) -> Column:
    """Lower-case hex MD5 of the natural key; ``md5(NULL)`` is NULL."""
    c = F.col(natural_key) if isinstance(natural_key, str) else natural_key
    return F.md5(c.cast("string"))
