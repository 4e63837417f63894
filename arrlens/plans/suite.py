"""The analysis suite: every result for one model and period, and the runner
that gates, exports and summarises them."""

from __future__ import annotations

import inspect
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import datasets as R
from ..operators import kpis as K
from ..operators.headline import headline_metrics
from ..operators.manifest import fingerprint_tree, published_manifest, run_manifest, table_fingerprint
from ..operators.quality import assert_quality, constraint_report, quality_report
from ..operators.reconcile import reconcile
from ..operators.rules import declared_rules, rule_report
from ..schema import Model, Period
from ..session import delete_path, move_path, shared_dir
from ..sources.snapshots import commit, new_snapshot
from ..sources.tables import export_observed, table_counts, write_json

# Result names in report order.
KPI_ORDER = ["quality_report", "executive_kpis", "monthly_revenue_growth", "channel_performance",
             "plan_segment_performance", "annual_retention", "growth_event_bridge",
             "churn_reasons", "sales_owner_performance", "customer_flow",
             "segment_churn_retention", "growth_quality"]


@dataclass
class Suite:
    """Lazily built results for one (model, period). Each result is built once
    per suite, so derived outputs (headline, reconciliation, datasets) reuse
    the same logical plans."""

    model: Model
    period: Period
    unique_keys: bool = False
    cache_results: bool = False
    _cache: dict = field(default_factory=dict)
    _locks: dict = field(default_factory=dict)
    _guard: object = field(default_factory=threading.Lock)

    def _get(self, name, build):
        """Build a result once per suite. With ``cache_results`` the (small,
        aggregated) result is materialised right away with a reliable
        checkpoint into the shared checkpoint folder: headline,
        reconciliation, datasets and manifest then reread a few rows from a
        lineage-free leaf instead of re-planning and recomputing the whole
        chain, and a lost executor does not force a recompute."""
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:  # threads build different results side by side, each once
            if name not in self._cache:
                df = build()
                if self.cache_results:
                    shared_dir(df.sparkSession)
                    df = df.checkpoint(eager=True)
                self._cache[name] = df
            return self._cache[name]

    def release(self) -> None:
        self._cache.clear()

    def kpi(self, name: str) -> DataFrame:
        def build():
            f = K.KPI_QUERIES[name]
            given = {"unique_keys": lambda: self.unique_keys, "months": self.months, "accounts": self.accounts}
            wanted = inspect.signature(f).parameters
            return f(self.model, self.period, **{k: v() for k, v in given.items() if k in wanted})
        return self._get(name, build)

    def months(self) -> DataFrame:
        """Month facts: a row for each month, read by all month-grain results."""
        return self._get("month_facts", lambda: K.month_facts(self.model, self.unique_keys))

    def accounts(self) -> DataFrame:
        """(customer, product) facts, read by all customer-grain results."""
        return self._get("account_facts", lambda: K.account_facts(self.model, self.period))

    def quality(self) -> DataFrame:
        return self._get("quality_report", lambda: quality_report(self.model, self.months(), self.accounts()))

    def constraints(self) -> DataFrame:
        return self._get("constraint_report", lambda: constraint_report(self.model, self.months(), self.accounts()))

    def results(self) -> dict[str, DataFrame]:
        out = {"quality_report": self.quality()}
        for n in KPI_ORDER[1:]:
            out[n] = self.kpi(n)
        return out

    def headline(self) -> DataFrame:
        return self._get("headline_metrics", lambda: headline_metrics(
            self.kpi("executive_kpis"), self.kpi("channel_performance"),
            self.kpi("annual_retention"), self.kpi("churn_reasons"),
            self.kpi("segment_churn_retention"), self.kpi("growth_quality"), self.period))

    def reconciliation(self, expected: dict | None = None) -> DataFrame:
        return self._get("reconciliation", lambda: reconcile(
            self.model, self.period, {n: self.kpi(n) for n in KPI_ORDER[1:]},
            self.quality(), self.constraints(), expected))

    def _dataset_builders(self) -> dict:
        return {
            "rpt_kpis": lambda: R.rpt_kpis(self.headline()),
            "rpt_monthly": lambda: R.rpt_monthly(self.kpi("monthly_revenue_growth")),
            "rpt_channels": lambda: R.rpt_channels(self.kpi("channel_performance")),
            "rpt_growth_events": lambda: R.rpt_growth_events(self.kpi("growth_event_bridge"),
                                                             self.period),
            "rpt_churn_reasons": lambda: R.rpt_churn_reasons(self.kpi("churn_reasons")),
            "rpt_logo_flow": lambda: R.rpt_logo_flow(self.kpi("customer_flow")),
            "rpt_growth_rates": lambda: R.rpt_growth_rates(self.kpi("customer_flow")),
            "rpt_segment_churn": lambda: R.rpt_segment_churn(self.kpi("segment_churn_retention")),
            "rpt_growth_quality": lambda: R.rpt_growth_quality(self.kpi("growth_quality")),
        }

    def dataset(self, name: str) -> DataFrame:
        """One report dataset; only the results it reads are built."""
        return self._dataset_builders()[name]()

    def datasets(self) -> dict[str, DataFrame]:
        return {n: build() for n, build in self._dataset_builders().items()}

    def manifest(self) -> DataFrame:
        return run_manifest(self.results())

    def table_counts(self) -> DataFrame:
        return table_counts(self.model)

    def fingerprint(self) -> DataFrame:
        return table_fingerprint(self.model)

    def fingerprints(self) -> DataFrame:
        return fingerprint_tree(self.model)

    def violations(self) -> DataFrame:
        return rule_report(self.model, declared_rules(self.model.domains))


def run_concurrently(actions: dict, threads: int = 4) -> dict[str, tuple[object, float]]:
    """Run independent Spark actions from a thread pool (one job each; Spark
    schedules concurrent jobs across the free cores). Returns
    ``{name: (result, seconds)}``; the first failure is re-raised."""
    def timed(fn):
        t = time.perf_counter()
        out = fn()
        return out, time.perf_counter() - t

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {n: pool.submit(timed, fn) for n, fn in actions.items()}
        return {n: f.result() for n, f in futures.items()}


class ReconciliationError(RuntimeError):
    """The reconciliation's verdict is negative: nothing was published."""


def run_analysis(suite: Suite, out_dir: str, expected: dict | None = None,
                 threads: int = 1) -> dict[str, str]:
    """Write, audit, publish. Quality checks must all be zero before any result
    is computed. Results, datasets, headline, manifest and reconciliation are
    then written to a staging folder; only if the reconciliation's verdict is
    positive does the folder become ``out_dir/run-<id>``, in one rename, and the
    pointer ``out_dir/_current.json`` names it. A failing run publishes nothing.

    Rows are counted and the verdict is read while the files are written. Build
    the suite with ``cache_results=True`` so each small result is computed once
    although the headline, manifest and reconciliation reread it; independent
    results are computed side by side. Returns the published paths."""
    assert_quality(suite.quality())
    suite.unique_keys = True  # proven by the gate
    run_concurrently({n: (lambda n=n: suite.kpi(n)) for n in KPI_ORDER[1:]}, threads)
    spark, run = suite.model.revenue.sparkSession, f"run-{new_snapshot()}"
    stage, results, verdict = f"{out_dir}/.staging-{run}", suite.results(), Observation()
    audited = suite.reconciliation(expected).observe(verdict, F.count_if(~F.col("passed")).alias("failed"))
    exports = {n: (lambda n=n, df=df: export_observed(df, f"{stage}/results/{n}")) for n, df in results.items()}
    exports |= {n: (lambda n=n, df=df: export_observed(df, f"{stage}/datasets/{n}")) for n, df in suite.datasets().items()}
    exports["headline_metrics"] = lambda: (write_json(suite.headline(), f"{stage}/headline_metrics"), 1)
    exports["reconciliation"] = lambda: (write_json(audited, f"{stage}/reconciliation"), None)
    try:
        done = {n: out for n, (out, _) in run_concurrently(exports, threads).items()}
        if verdict.get["failed"]:
            failed = suite.reconciliation(expected).where("not passed").select("check_name", "evidence").collect()
            raise ReconciliationError(f"Reconciliation failed: {[r.asDict() for r in failed]}")
        paths = {n: path.replace(stage, f"{out_dir}/{run}", 1) for n, (path, _) in done.items()}
        manifest = published_manifest(spark, results, paths, {n: rows for n, (_, rows) in done.items()})
        write_json(manifest, f"{stage}/run_manifest")
        move_path(spark, stage, f"{out_dir}/{run}")
    except BaseException:
        delete_path(spark, stage)
        raise
    commit(spark, out_dir, {"run": run})
    return paths | {"run_manifest": f"{out_dir}/{run}/run_manifest"}
