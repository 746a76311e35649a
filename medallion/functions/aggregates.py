"""Aggregate expressions with engine-independent numeric results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mean(x: Column | str) -> Column:
    """``AVG`` as ``double(SUM) / COUNT``: the sum is exact (decimal/integer),
    so the quotient is one correctly rounded division — identical in any IEEE
    engine, unlike a running floating-point mean. NULL for an empty group."""
    c = _c(x)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def ratio(num: Column, den: Column) -> Column:
    """``num * 1.0 / den`` as a double; NULL when ``den`` is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def count_true(flag: Column | str) -> Column:
    """``SUM(CASE WHEN flag THEN 1 ELSE 0 END)``."""
    return F.sum(F.when(_c(flag), 1).otherwise(0)).cast("bigint")
