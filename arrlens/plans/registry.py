"""Every registered query as ``(spark, sf_dir) -> DataFrame``.

Each query reads the model derived from the driver tables in ``sf_dir`` (built
and stored once per session, see ``shared_suite``) and returns the requested
result over the whole tables.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_spine
from ..operators.kpis import KPI_QUERIES
from ..operators.lifecycle import panel_from_lifecycles
from ..operators.quality import quality_report
from ..operators.rules import declared_rules, rule_report
from ..schema import Period
from ..session import delete_path, path_version, scratch_path
from ..sources.orders import (ORDER_DOMAINS, lifecycle_specs, model_from_orders,
                              model_with_defects, order_period)
from ..sources.tables import load_model, save_model
from .suite import Suite

QueryFn = Callable[[SparkSession, str], DataFrame]


SOURCE_TABLES = ("orders", "customer", "nation", "region")
_SUITES: dict = {}
_SUITES_LOCK = threading.Lock()


def shared_suite(spark: SparkSession, sf_dir: str, period: Period | None = None) -> Suite:
    """One suite per (session, data folder and state, period), only reused by
    the very session that built it. On first use the model is derived from the
    orders and written to the shared checkpoint folder (tables committed through the
    output protocol, revenue partitioned by month), then read back: a lost
    executor costs a re-read of files, not a rebuild of the panel, and the
    single-month scans prune. Its small results are checkpointed into the
    same folder once, so a run of many registered queries derives the panel
    and each KPI once; the headline, reconciliation and report datasets
    reread those results. Rewritten input files give a new suite."""
    state = tuple(path_version(spark, f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES)
    key = (sf_dir, state, period)
    with _SUITES_LOCK:
        held = _SUITES.get(key)
        if held is not None and held[0] is spark:
            return held[1]
        own = period or order_period(spark, sf_dir)
        built = model_from_orders(spark, sf_dir, own, checkpoint_segments=True)
        path = save_model(built, scratch_path(spark, "model"), concurrent=True)
        model = load_model(spark, path, ORDER_DOMAINS)
        model.segments = built.segments  # checkpointed: the lifecycle panel reads them
        suite = Suite(model, own, cache_results=True)
        _SUITES[key] = (spark, suite, path)
        return suite


def release_shared() -> None:
    """Forget the shared suites and delete their stored models."""
    with _SUITES_LOCK:
        for spark, suite, path in _SUITES.values():
            suite.release()
            delete_path(spark, path)
        _SUITES.clear()


def suite_for(spark: SparkSession, sf_dir: str, period: Period | None = None,
              shared: bool = True) -> Suite:
    """The shared suite, or (``shared=False``) a fresh lazy one whose results
    carry their full plans (nothing persisted or checkpointed)."""
    if shared:
        return shared_suite(spark, sf_dir, period)
    own = period or order_period(spark, sf_dir)
    return Suite(model_from_orders(spark, sf_dir, own), own)


def month_coverage(suite: Suite) -> DataFrame:
    """P2 month spine of the model's months, left-joined to the panel's monthly
    rows and customers: months without revenue show up with zeros."""
    p = suite.period
    spark = suite.model.revenue.sparkSession
    spine = month_spine(spark, p.history_start, p.history_end)
    mon = suite.months().select("revenue_month", "revenue_rows", "active_customers")
    return spine.join(mon, "revenue_month", "left").select(
        "revenue_month",
        F.coalesce("revenue_rows", F.lit(0)).cast("long").alias("revenue_rows"),
        F.coalesce("active_customers", F.lit(0)).cast("long").alias("active_customers"),
    ).orderBy("revenue_month")


def lifecycle_panel(suite: Suite) -> DataFrame:
    """The panel rebuilt from lifecycle specs (contract/churn months, pauses,
    plan changes) read off the model's segments; must equal ``subscription_panel``."""
    lifecycles, pauses, changes = lifecycle_specs(suite.model.segments, suite.period)
    return panel_from_lifecycles(lifecycles, pauses, changes, suite.model.products, suite.period)


def registry(shared: bool = True) -> dict[str, QueryFn]:
    """All registered queries. ``shared`` (the default) runs them on one
    shared suite per session and data folder; ``shared=False`` gives each
    call a fresh lazy suite, for looking at the full plans."""
    def _from_suite(build: Callable[[Suite], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(suite_for(spark, sf_dir, shared=shared))
        return run

    def _kpi(name: str) -> QueryFn:
        return _from_suite(lambda s: s.kpi(name))

    def _dataset(name: str) -> QueryFn:
        return _from_suite(lambda s: s.dataset(name))

    q: dict[str, QueryFn] = {
        "subscription_panel": _from_suite(lambda s: s.model.revenue),
        "churn_facts": _from_suite(lambda s: s.model.churn),
        "customer_status": _from_suite(lambda s: s.model.customers),
        "month_coverage": _from_suite(month_coverage),
        "lifecycle_panel": _from_suite(lifecycle_panel),
        "quality_report": _from_suite(lambda s: s.quality()),
        "constraint_report": _from_suite(lambda s: s.constraints()),
        "quality_report_dirty": _from_suite(
            lambda s: quality_report(model_with_defects(s.model))),
    }
    for name in KPI_QUERIES:
        q[name] = _kpi(name)
    q["headline_metrics"] = _from_suite(lambda s: s.headline())
    q["reconciliation"] = _from_suite(lambda s: s.reconciliation().select("check_name", "severity", "passed"))
    q["reconciliation_evidence"] = _from_suite(lambda s: s.reconciliation().select("check_name", "evidence"))
    q["table_fingerprint"] = _from_suite(lambda s: s.fingerprint())
    q["fingerprint_tree"] = _from_suite(lambda s: s.fingerprints())
    q["rule_violations"] = _from_suite(lambda s: s.violations())
    q["rule_violations_dirty"] = _from_suite(
        lambda s: rule_report(model_with_defects(s.model), declared_rules(s.model.domains)))
    q["run_manifest"] = _from_suite(lambda s: s.manifest())
    q["table_counts"] = _from_suite(lambda s: s.table_counts())
    for name in ["rpt_kpis", "rpt_monthly", "rpt_channels", "rpt_growth_events",
                 "rpt_churn_reasons", "rpt_logo_flow", "rpt_growth_rates",
                 "rpt_segment_churn", "rpt_growth_quality"]:
        q[name] = _dataset(name)
    return q
