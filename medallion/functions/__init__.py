"""Column-level helpers that pin the warehouse dialect's semantics onto Spark
built-ins. All return native ``Column`` expressions (no UDFs), so they stay in
whole-stage codegen and work in batch and streaming plans alike."""

from medallion.functions.dates import (
    date_key,
    day_boundaries,
    day_of_week_sunday0,
    hour_boundaries,
    padded_name,
    strict_greatest,
)
from medallion.functions.keys import surrogate_key
from medallion.functions.ranking import keep_first, latest_struct

__all__ = [
    "date_key",
    "day_boundaries",
    "day_of_week_sunday0",
    "hour_boundaries",
    "keep_first",
    "latest_struct",
    "padded_name",
    "strict_greatest",
    "surrogate_key",
]
