"""One-pass row rules: a violation bit mask for each row, counted per bit.

A rule is a name, a table and a condition that bad rows meet. All rules of a
table are evaluated in one scan: a row's bits say which it breaks, clean rows
(the mask 0) go no further, and the others are reduced map-side to one row for
each mask, with their number and a bounded sample of their keys (the least and
the greatest). Counts per rule are read off those few rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PRIMARY_KEYS, REQUIRED_COLUMNS, Domains, Model

#: Rules whose bits fit in a mask.
MASK_BITS = 62
NUMERIC_DOMAINS = [
    # (table, column, rule) rule: 'gt0' or 'ge0'
    ("products", "base_monthly_price_inr", "gt0"),
    ("revenue", "opening_mrr_inr", "ge0"),
    ("revenue", "movement_mrr_inr", "ge0"),
    ("revenue", "closing_mrr_inr", "gt0"),
    ("revenue", "recognized_revenue_inr", "gt0"),
    ("revenue", "arr_run_rate_inr", "gt0"),
    ("churn", "mrr_lost_inr", "gt0"),
    ("churn", "tenure_months", "gt0"),
]


@dataclass(frozen=True)
class Rule:
    """A check and a condition of its table's bad rows. Several rules of one
    check add up (a row with two null columns counts twice)."""

    check: str
    table: str
    bad: Column


def declared_rules(domains: Domains) -> list[Rule]:
    """Not-null (C4), enum (C5), numeric (C6) and arithmetic (C7) rules."""
    out = [Rule(f"not_null_{t}", t, F.col(c).isNull()) for t, cols in REQUIRED_COLUMNS.items() for c in cols]
    out += [Rule(name, t, ~F.col(col).isin(*values)) for name, t, col, values in (
        ("enum_revenue_type", "revenue", "revenue_type", domains.revenue_types),
        ("enum_plan_tier", "products", "plan_tier", domains.plan_tiers),
        ("enum_company_segment", "customers", "company_segment", domains.segments),
        ("enum_lifecycle_status", "customers", "lifecycle_status", domains.lifecycle_statuses))]
    out += [Rule(f"domain_{t}_{c}", t, F.col(c) <= 0 if kind == "gt0" else F.col(c) < 0) for t, c, kind in NUMERIC_DOMAINS]
    arr = F.col("arr_run_rate_inr") != F.col("closing_mrr_inr") * 12
    fall = F.col("opening_mrr_inr") + F.col("movement_mrr_inr") != F.col("closing_mrr_inr")
    return out + [Rule("arr_math", "revenue", arr), Rule("waterfall_math", "revenue", fall)]


def masks(table: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """(mask, rows, first_key, last_key) of the rows that break a rule: one
    scan, and no more rows than masks occur."""
    if len(rules) > MASK_BITS:
        raise ValueError(f"a mask holds {MASK_BITS} rules of a table")
    bits = [F.when(r.bad, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    rows = table.select(mask.alias("mask"), F.col(key).cast("string").alias("key")).where("mask <> 0")
    return rows.groupBy("mask").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


def _checks(rules: Iterable[Rule]) -> dict[str, int]:
    """The bits of each check."""
    out: dict[str, int] = {}
    for i, r in enumerate(rules):
        out[r.check] = out.get(r.check, 0) | 1 << i
    return out


def rule_report(model: Model, rules: list[Rule]) -> DataFrame:
    """(check_name, issue_count, first_key, last_key), a row for each check: how
    often it is broken, and the least and the greatest key of rows that break it."""
    tables, parts = model.tables(), []
    for t in tables:
        own = [r for r in rules if r.table == t]
        if not own:
            continue
        found, checks = masks(tables[t], own, PRIMARY_KEYS[t]), _checks(own)
        # One row of all checks' totals, so that checks without a bad row have one too.
        cells = []
        for i, bits in enumerate(checks.values()):
            hit = F.col("mask").bitwiseAND(F.lit(bits))
            cells += [F.coalesce(F.sum(F.bit_count(hit) * F.col("rows")), F.lit(0)).cast("long").alias(f"n{i}"),
                      F.min(F.when(hit != 0, F.col("first_key"))).alias(f"a{i}"),
                      F.max(F.when(hit != 0, F.col("last_key"))).alias(f"z{i}")]
        row = found.agg(*cells)
        named = [F.struct(F.lit(c).alias("check_name"), F.col(f"n{i}").alias("issue_count"), F.col(f"a{i}").alias("first_key"),
                          F.col(f"z{i}").alias("last_key")) for i, c in enumerate(checks)]
        parts.append(row.select(F.inline(F.array(*named))))
    return reduce(lambda a, b: a.unionByName(b), parts)
