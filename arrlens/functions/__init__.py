"""Column-level helpers: month arithmetic and null-safe measures."""

from .measures import (combine_single_rows, count_when, growth_pct, nullif_zero,
                       pct, rate, ratio, raw_growth, scaled, sum_when)
from .months import (fiscal_year, month_add, month_diff, month_from_index,
                     month_index, month_key, month_spine)

__all__ = [
    "combine_single_rows", "count_when", "growth_pct", "nullif_zero", "pct",
    "rate", "ratio", "raw_growth", "scaled", "sum_when", "fiscal_year",
    "month_add", "month_diff", "month_from_index", "month_index", "month_key",
    "month_spine",
]
