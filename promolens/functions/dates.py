"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(day: Column) -> Column:
    """Month label such as ``2024-03``."""
    return F.date_format(day, "yyyy-MM")


def completed_months(start: Column, end: Column) -> Column:
    """Whole months from ``start`` to ``end``: 31 January to 28 February is 0, negative backwards.

    Uses date parts only, so the session time zone has no say in it.
    """
    calendar = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    short_forward = (end >= start) & (F.dayofmonth(end) < F.dayofmonth(start))
    short_backward = (end < start) & (F.dayofmonth(end) > F.dayofmonth(start))
    return calendar - short_forward.cast("int") + short_backward.cast("int")
