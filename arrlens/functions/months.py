"""Month arithmetic on Spark columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(d: date) -> Column:
    return F.lit(d)


def month_index(col: Column | str) -> Column:
    """Absolute month number ``year * 12 + month - 1`` (works on dates and
    timestamps, time-zone free for DATE / TIMESTAMP_NTZ)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 12 + F.month(c) - 1).cast("long")


def month_from_index(idx: Column | str) -> Column:
    """First-of-month DATE of an absolute month number."""
    c = F.col(idx) if isinstance(idx, str) else idx
    return F.make_date((c / 12).cast("long").cast("int"),
                       (c % 12 + 1).cast("int"), F.lit(1))


def month_add(col: Column | str, n: int | Column) -> Column:
    """First of the month ``n`` months after ``col``'s month."""
    c = F.col(col) if isinstance(col, str) else col
    return F.add_months(F.trunc(c, "MM"), n)


def month_diff(start: Column | str, end: Column | str) -> Column:
    """Whole calendar months from ``start`` to ``end``."""
    return month_index(end) - month_index(start)


def month_key(col: Column | str) -> Column:
    """Calendar month bucket (first of month) of an event date."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trunc(c, "MM")


def fiscal_year(col: Column | str, fy_end_month: int = 12) -> Column:
    """Fiscal year label of a date: the calendar year in which its fiscal year
    ends. Equals ``year(col)`` for calendar years."""
    c = F.col(col) if isinstance(col, str) else col
    if fy_end_month == 12:
        return F.year(c).cast("long")
    return F.year(F.add_months(c, 12 - fy_end_month)).cast("long")


def month_spine(spark, start: date, end: date, name: str = "revenue_month"):
    """Inclusive month spine as a one-column DataFrame."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end),
                             F.expr("interval 1 month"))).alias(name))


def month_sequence(lo: Column, hi: Column) -> Column:
    """Array of month numbers ``lo..hi`` (caller guarantees lo <= hi)."""
    return F.sequence(lo, hi)
