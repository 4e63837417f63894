"""Incremental refresh of a published model from appended orders.

Only customers that the appended orders can change are rebuilt, from all their
orders: those with new orders and, if the history now ends later, those that
were active in the month it ended with (nobody else's months, status or churn
can differ). Their old and new revenue are compared month by month, and only
months that differ are written again: everybody else's rows of the month with
the rebuilt ones. Other months keep their files. Customers and churn hold a row
for each customer and are written anew (attributes of customers that are not
rebuilt stay as they were). The pointer then moves to the new state
as a whole (see ``snapshots``), so readers see the old model or the new one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifest import differences, month_digests
from ..operators.panel import (DEFAULT_TERM_MONTHS, churn_facts, contract_months, customer_id_col,
                               customer_lifecycle, customer_status, expand_panel, lifecycle_segments)
from ..schema import Model, Period, add_months
from ..session import shared_dir
from .orders import ENTERPRISE_MRR_THRESHOLD, ORDER_DOMAINS, assemble_customers, customer_dimension, order_events, read
from .snapshots import new_snapshot, read_pointer, written_months
from .tables import load_model, next_number, publish, write_revenue


def changed_customers(old: Model, appended: DataFrame, old_end: date, period: Period) -> DataFrame:
    """(customer_key, customer_id) of the customers that appended orders can change."""
    after = add_months(period.history_end, 1)
    ordered = appended.where(F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz")).select(F.col("o_custkey").alias("customer_key"))
    if period.history_end > old_end:  # whoever was active at the old end lapses or goes on
        active = old.revenue.where(F.col("revenue_month") == F.lit(old_end)).select(F.expr("substring(customer_id, 2)").cast("long").alias("customer_key"))
        ordered = ordered.union(active)
    return ordered.distinct().select("customer_key", customer_id_col().alias("customer_id"))


def changed_months(old_rows: DataFrame, new_rows: DataFrame) -> list[date]:
    """Months in which the two differ: at most the months of the history."""
    return [date.fromisoformat(r.part) for r in differences(month_digests(old_rows), month_digests(new_rows)).collect()]


def _without(rows: DataFrame, changed: DataFrame) -> DataFrame:
    return rows.join(changed.select("customer_id"), "customer_id", "left_anti")


def refresh_model(spark: SparkSession, path: str, sf_dir: str, appended: DataFrame, old_period: Period, period: Period,
                  tier_threshold: int = ENTERPRISE_MRR_THRESHOLD, term_months: int = DEFAULT_TERM_MONTHS,
                  check: Callable[[Model], None] | None = None) -> list[date]:
    """Bring the model published in ``path`` (of ``old_period``) up to date with
    ``sf_dir``, whose orders now also hold the rows ``appended``. The history may
    grow at its end. ``check`` may refuse the result before it is published.
    Returns the months that were written again."""
    if period.history_start != old_period.history_start or period.history_end < old_period.history_end:
        raise ValueError("a refresh keeps the history's first month and its months so far")
    pointer = read_pointer(spark, path)
    old = load_model(spark, path, ORDER_DOMAINS, pointer)
    shared_dir(spark)
    changed = changed_customers(old, appended, old_period.history_end, period).checkpoint(eager=True)

    events = order_events(read(spark, sf_dir, "orders"))
    own = events.join(changed.select("customer_key"), "customer_key", "left_semi")
    segments = lifecycle_segments(contract_months(own, period), period, tier_threshold, term_months,
                                  first_number=pointer["next_number"]).checkpoint(eager=True)
    rebuilt = expand_panel(segments, period, numbered=pointer["numbered"])
    held = old.numbered if pointer["numbered"] else old.revenue
    months = changed_months(held.join(changed.select("customer_id"), "customer_id", "left_semi"), rebuilt)

    snapshot = new_snapshot()
    within = F.col("revenue_month").isin(*[F.lit(m) for m in months]) if months else F.lit(False)
    write_revenue(_without(held.where(within), changed).unionByName(rebuilt.where(within)), path, snapshot)
    lifecycle = customer_lifecycle(segments, period, tier_threshold, term_months)
    customers = assemble_customers(customer_status(lifecycle), customer_dimension(spark, sf_dir))
    for name, rows in (("customers", customers), ("churn", churn_facts(lifecycle, own))):
        _without(getattr(old, name), changed).unionByName(rows).write.parquet(f"{path}/{name}/{snapshot}")

    # A month whose last row went away has no folder any more.
    written = {m: snapshot for m in written_months(spark, f"{path}/revenue", snapshot)}
    left = {m: s for m, s in pointer["months"].items() if m not in {str(m) for m in months}}
    publish(spark, path, {"tables": pointer["tables"] | {"customers": snapshot, "churn": snapshot},
                          "months": left | written, "numbered": pointer["numbered"],
                          "next_number": max(pointer["next_number"], next_number(replace(old, segments=segments)))},
            ORDER_DOMAINS, check)
    return months
