"""Data-quality (D1-D11) and declared-constraint (C1-C7) checks.

Both reports have the shape ``(check_name string, issue_count long)``; a clean
model has only zeros. Rules of single rows are one scan a table (``rules``).
Keys are reduced once: revenue's (month, customer) uniqueness is read off the
month facts and its foreign keys off the (customer, product) facts, which a
suite builds for its results anyway, so no check of a suite scans revenue for
itself but its primary key; anti joins meet one row per distinct key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import combine_single_rows
from ..schema import FOREIGN_KEYS, PRIMARY_KEYS, Model
from .kpis import month_facts
from .rules import declared_rules, rule_report


class QualityGateError(RuntimeError):
    pass


def _stack(row: DataFrame, names: list[str]) -> DataFrame:
    """One-row DataFrame of counts -> one (check_name, issue_count) row per column."""
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    return row.selectExpr(f"stack({len(names)}, {pairs}) AS (check_name, issue_count)")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_rows(child: DataFrame, *cols: str) -> DataFrame:
    """``child`` reduced to (cols..., _rows) with a two-phase aggregate: one
    row per key combination, however many fact rows share it."""
    return child.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))


def orphan_count(reduced: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                 skip_null: bool = False) -> DataFrame:
    """Keys of a ``key_rows`` reduction with no match in ``parent``, with the
    number of child rows behind each (``_k``, ``_n``).

    The anti join runs on distinct keys only. A null key never matches, so
    it counts as an orphan unless ``skip_null``."""
    keys = reduced.groupBy(F.col(child_col).alias("_k")).agg(F.sum("_rows").alias("_n"))
    if skip_null:
        keys = keys.where(F.col("_k").isNotNull())
    par = parent.select(F.col(parent_col).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    return keys.join(par, "_k", "left_anti")


def _orphan_total(name, reduced, child_col, parent, parent_col, skip_null=False) -> DataFrame:
    """One row, one column ``name``: child rows whose key has no parent."""
    o = orphan_count(reduced, child_col, parent, parent_col, skip_null)
    return o.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(name))


def _orphans(name, reduced, child_col, parent, parent_col, skip_null=False) -> DataFrame:
    return _stack(_orphan_total(name, reduced, child_col, parent, parent_col, skip_null), [name])


# Check names of the quality report, in report order.
QUALITY_CHECKS = ["duplicate_customer_id", "duplicate_customer_month", "orphan_revenue_customer",
                  "orphan_revenue_product", "orphan_churn_customer", "invalid_arr_math",
                  "reactivated_customer_in_churn", "churn_status_mismatch", "smb_records"]


def revenue_keys(model: Model, accounts: DataFrame | None) -> DataFrame:
    """Revenue reduced to (customer_id, product_id, reactivations, _rows): the
    (customer, product) facts, or what they would be."""
    if accounts is None:
        accounts = model.revenue.groupBy("customer_id", "product_id").agg(
            F.count(F.lit(1)).alias("revenue_rows"), F.count_if(F.col("revenue_type") == "Reactivation").alias("reactivations"))
    return accounts.select("customer_id", "product_id", "reactivations", F.col("revenue_rows").alias("_rows"))


def quality_report(model: Model, months: DataFrame | None = None, accounts: DataFrame | None = None) -> DataFrame:
    """The nine zero-tolerance checks.

    ``months`` and ``accounts`` are the suite's month and (customer, product)
    facts; given them, revenue is not read at all. Every check is a one-row
    aggregate; they are merged into one row and stacked once in report order."""
    cu, rv, ch, pr = model.customers, model.revenue, model.churn, model.products
    d = model.domains
    facts = month_facts(model) if months is None else months
    cust_row = cu.agg(
        (F.count(F.lit(1)) - F.count_distinct("customer_id")).alias("duplicate_customer_id"),
        F.count_if(F.col("company_segment") == F.lit(d.forbidden_segment)).alias("smb_records"))
    # Rows beyond the first of a (month, customer), and rows without one of both.
    pairs = F.when(F.col("revenue_month").isNotNull(), F.col("active_customers")).otherwise(F.lit(0))
    rev_row = facts.agg(
        F.coalesce(F.sum("revenue_rows") - F.sum(pairs), F.lit(0)).alias("duplicate_customer_month"),
        F.coalesce(F.sum("bad_arr"), F.lit(0)).alias("invalid_arr_math"))
    rv_keys = revenue_keys(model, accounts)
    # D7 counts join rows (not customers): sum of reactivation rows per churned customer.
    react = (rv_keys.where("reactivations > 0")
             .groupBy("customer_id").agg(F.sum("reactivations").alias("_n")))
    d7 = ch.select("customer_id").join(react, "customer_id").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("reactivated_customer_in_churn"))
    not_churned = cu.where(F.col("lifecycle_status") != "Churned").select("customer_id")
    d8 = ch.select("customer_id").join(not_churned, "customer_id").agg(
        F.count(F.lit(1)).cast("long").alias("churn_status_mismatch"))
    row = combine_single_rows(
        cust_row, rev_row,
        _orphan_total("orphan_revenue_customer", rv_keys, "customer_id", cu, "customer_id"),
        _orphan_total("orphan_revenue_product", rv_keys, "product_id", pr, "product_id"),
        _orphan_total("orphan_churn_customer", key_rows(ch, "customer_id"), "customer_id",
                      cu, "customer_id"),
        d7, d8)
    return _stack(row, QUALITY_CHECKS)


def inject_defects(model: Model, duplicate_segment: str, forbidden_from_segment: str,
                   status_flip_segment: str, orphan_churn_reason: str,
                   unknown_suffix: str = "-X", unknown_product: str = "P999") -> Model:
    """A copy of ``model`` with rule-chosen defects, so every quality check
    has a non-zero count. Each defect is picked by a data value (segment,
    revenue type, status, churn reason) over the whole tables, never by key:

    * customers: ``forbidden_from_segment`` becomes the forbidden segment (D9);
      churned customers of ``status_flip_segment`` are marked Active (D8);
      rows of ``duplicate_segment`` appear twice (D1).
    * revenue: Upgrade rows appear twice (D2); Expansion rows point at an
      unknown customer (D3), Reactivation rows at an unknown product (D4);
      New rows carry ARR + 1 (D6); New rows of churned customers are typed
      Reactivation (D7).
    * churn: rows with ``orphan_churn_reason`` point at an unknown customer (D5).
    """
    cu, rv, ch = model.customers, model.revenue, model.churn
    seg, status = F.col("company_segment"), F.col("lifecycle_status")
    cu2 = cu.withColumns({
        "company_segment": F.when(seg == forbidden_from_segment,
                                  F.lit(model.domains.forbidden_segment)).otherwise(seg),
        "lifecycle_status": F.when((seg == status_flip_segment) & (status == "Churned"),
                                   F.lit("Active")).otherwise(status),
    })
    cu2 = cu2.unionByName(cu2.where(F.col("company_segment") == duplicate_segment))
    # Only a customer's New row meets the churned customers (one row each); the
    # rest of the fact is changed, and Upgrade rows doubled, row by row.
    churned = ch.select("customer_id", F.lit(True).alias("_churned")).distinct()
    rtype = F.col("revenue_type")
    is_new = F.coalesce(rtype == "New", F.lit(False))
    new = rv.where(is_new).join(churned, "customer_id", "left").select(
        *[F.when(F.col("_churned"), F.lit("Reactivation")).otherwise(rtype).alias(c) if c == "revenue_type"
          else (F.col(c) + 1).alias(c) if c == "arr_run_rate_inr" else F.col(c) for c in rv.columns])
    times = F.when(rtype == "Upgrade", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rest = rv.where(~is_new).withColumns({
        "customer_id": F.when(rtype == "Expansion", F.concat("customer_id", F.lit(unknown_suffix)))
        .otherwise(F.col("customer_id")),
        "product_id": F.when(rtype == "Reactivation", F.lit(unknown_product)).otherwise(F.col("product_id")),
    }).withColumn("_time", F.explode(times)).drop("_time")
    rv2 = new.unionByName(rest)
    ch2 = ch.withColumn("customer_id", F.when(
        F.col("churn_reason") == orphan_churn_reason,
        F.concat("customer_id", F.lit(unknown_suffix))).otherwise(F.col("customer_id")))
    return Model(customers=cu2, products=model.products, revenue=rv2, churn=ch2,
                 domains=model.domains)


def assert_quality(report: DataFrame) -> DataFrame:
    """D11 fail-fast gate. The report is a handful of rows, so fetching the
    failing ones to raise a readable error is bounded."""
    failed = report.where(F.col("issue_count") != 0).collect()
    if failed:
        raise QualityGateError(f"Data quality checks failed: {[r.asDict() for r in failed]}")
    return report


# ---------------------------------------------------------------------------
# Declared constraints
# ---------------------------------------------------------------------------
def constraint_report(model: Model, months: DataFrame | None = None, accounts: DataFrame | None = None) -> DataFrame:
    """Keys, foreign keys, not-null, enum and numeric domains, ARR and
    waterfall arithmetic. Row rules are one scan per table; each table's keys
    are reduced once, and its unique and foreign keys read the reduction.
    ``months`` and ``accounts`` are the suite's facts, which hold revenue's."""
    tables = model.tables()
    facts = month_facts(model) if months is None else months
    held = F.col("revenue_month").isNotNull()
    pairs = facts.agg(F.coalesce(F.sum(F.when(held, F.col("customer_rows") - F.col("active_customers"))), F.lit(0))
                      .alias("unique_revenue_month_customer"))
    parts = [_surplus(f"pk_unique_{t}", tables[t], [pk]) for t, pk in PRIMARY_KEYS.items()]
    parts.append(_stack(pairs, ["unique_revenue_month_customer"]))
    reduced = {"customers": key_rows(tables["customers"], "initial_product_id", "current_product_id"),
               "churn": key_rows(tables["churn"], "customer_id", "product_id"), "revenue": revenue_keys(model, accounts)}
    once = reduced["churn"].where("customer_id is not null").groupBy("customer_id").agg(F.sum("_rows").alias("_rows"))
    parts.append(_stack(once.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("unique_churn_customer")),
                        ["unique_churn_customer"]))
    parts.append(rule_report(model, declared_rules(model.domains)).select("check_name", "issue_count"))
    # A null foreign key is not a violation.
    parts += [_orphans(f"fk_{child}_{col}", reduced[child], col, tables[parent], pcol, skip_null=True)
              for child, col, parent, pcol in FOREIGN_KEYS]
    return _union(parts)


def _surplus(name: str, table: DataFrame, cols: list[str]) -> DataFrame:
    """One row: rows that repeat a key (keys with a null don't count)."""
    keys = table.select(*cols).dropna()
    repeats = key_rows(keys, *cols).where(F.col("_rows") > 1)
    return _stack(repeats.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias(name)), [name])
