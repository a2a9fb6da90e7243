"""Date arithmetic with BigQuery's boundary-counting semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_diff(end: Column, start: Column) -> Column:
    """``date_diff(end, start, DAY)`` as a long."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("long")


def month_diff(end: Column, start: Column) -> Column:
    """Month *boundaries* crossed from ``start`` to ``end``.

    Spark's ``datediff(MONTH, ...)`` counts whole elapsed months instead
    (2023-12-31 -> 2024-01-01 is 0 there, 1 here).
    """
    return ((F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))).cast("long")


def year_diff(end: Column, start: Column) -> Column:
    """Year boundaries crossed (``date_diff(end, start, YEAR)``)."""
    return (F.year(end) - F.year(start)).cast("long")


def quarter_label(d: Column) -> Column:
    """``YYYY-Qn`` of a date."""
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def month_label(d: Column) -> Column:
    """``YYYY-MM`` of a date or timestamp."""
    return F.date_format(d, "yyyy-MM")
