"""Null-safe ratio, rounding and scaling helpers used by every metric."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CRORE


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nullif_zero(x: Column | str) -> Column:
    x = c(x)
    return F.when(x != 0, x)


def pct(num: Column | str, den: Column | str, dp: int = 1) -> Column:
    """``round(100.0 * num / nullif(den, 0), dp)`` in double arithmetic.

    The factor is a DOUBLE literal so the product never becomes a DECIMAL, and
    the zero guard keeps ANSI mode from raising on an empty denominator."""
    return F.round(F.lit(100.0) * c(num) / nullif_zero(den), dp)


def ratio(num: Column | str, den: Column | str, dp: int = 0) -> Column:
    """``round(1.0 * num / nullif(den, 0), dp)`` in double arithmetic."""
    return F.round(F.lit(1.0) * c(num) / nullif_zero(den), dp)


def growth_pct(cur: Column | str, prev: Column | str, dp: int = 1) -> Column:
    return pct(c(cur) - c(prev), prev, dp)


def raw_growth(cur: Column | str, prev: Column | str) -> Column:
    """Unrounded ``100.0 * (cur - prev) / nullif(prev, 0)``."""
    return F.lit(100.0) * (c(cur) - c(prev)) / nullif_zero(prev)


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: 0 (not null) on rows."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def sum_when(cond: Column, value: Column | str, default_zero: bool = True) -> Column:
    """Conditional sum. With ``default_zero`` it is ``SUM(CASE .. ELSE 0)``
    (0 when rows exist); without, ``SUM`` over the matching rows only (null
    when none match)."""
    v = F.when(cond, c(value))
    if default_zero:
        v = v.otherwise(F.lit(0))
    return F.sum(v).cast("long")


def scaled(x: Column | str, divisor: int = CRORE, dp: int = 2) -> Column:
    """Scale whole INR to e.g. crore, rounded half away from zero at ``dp``.

    Rounding is done in integer arithmetic on the whole-INR value, so it does
    not depend on how a binary double represents ``x / divisor``; only the
    final ``k / 10^dp`` is a double division."""
    unit = divisor // 10 ** dp
    if unit * 10 ** dp != divisor or unit < 2:
        raise ValueError("divisor must be a multiple of 10^(dp+1)")
    v = F.abs(c(x).cast("long")) + F.lit(unit // 2)
    k = F.call_function("div", v, F.lit(unit))
    return F.signum(c(x)) * k / F.lit(float(10 ** dp))


def rate(pct_col: Column | str) -> Column:
    """Percentage to fraction; null stays null."""
    return c(pct_col) / F.lit(100.0)


def combine_single_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row aggregates with disjoint columns into one row.

    Each input is a global aggregate (exactly one row). They are stacked with
    ``unionByName`` and folded with ``first(ignorenulls)``; every column is
    non-null in at most one input row, so the fold is deterministic. This
    replaces a chain of 1x1 cross joins."""
    cols: list[str] = []
    for f in frames:
        for name in f.columns:
            if name in cols:
                raise ValueError(f"duplicate column {name}")
            cols.append(name)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(n, ignorenulls=True).alias(n) for n in cols])
