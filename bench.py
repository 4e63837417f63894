"""Benchmark: build the subscription model from the driver tables, store it,
then run every analysis on the stored model.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from arrlens.operators.quality import assert_quality, quality_report  # noqa: E402
from arrlens.plans.registry import lifecycle_panel, month_coverage  # noqa: E402
from arrlens.plans.suite import KPI_ORDER, Suite, run_concurrently  # noqa: E402
from arrlens.session import delete_path, local_session, scratch_path  # noqa: E402
from arrlens.sources.orders import ORDER_DOMAINS, model_from_orders, model_with_defects, order_period  # noqa: E402
from arrlens.sources.tables import load_model, save_model  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus * 2, 8),
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          app="arrlens-bench",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="arrlens-bench-")})
    p = order_period(spark, sf_dir)
    times: dict[str, float] = {}     # per job (jobs of one phase overlap)
    phases: dict[str, float] = {}    # wall clock; their sum is the headline value

    # 1. Model build: orders -> panel, churn, customers; written once to the
    #    shared folder (cuts lineage; every analysis below reads the files).
    path = scratch_path(spark, "model")
    def build():
        model = model_from_orders(spark, sf_dir, p, checkpoint_segments=True)
        save_model(model, path, concurrent=True)
        return model
    built, times["model_build"] = timed(build)
    phases["model_build"] = times["model_build"]
    model = load_model(spark, path, ORDER_DOMAINS)

    # 2. Quality gate; it builds the month and account facts, which the results
    #    below read too (customers counted exactly, as in the registered queries).
    suite = Suite(model, p, cache_results=True)
    _, times["quality_report"] = timed(lambda: assert_quality(suite.quality()))
    phases["quality_gate"] = times["quality_report"]

    # 3. Every result, each collected to the driver (results are small).
    #    Independent results run as concurrent jobs; derived outputs
    #    (headline, reconciliation, datasets, manifest) reread the cached
    #    results afterwards.
    threads = int(os.environ.get("BENCH_THREADS", str(max(1, cpus // 2))))
    first = {n: (lambda n=n: suite.kpi(n).collect()) for n in KPI_ORDER[1:]}
    first["constraint_report"] = lambda: suite.constraints().collect()
    first["month_coverage"] = lambda: month_coverage(suite).collect()
    t0 = time.perf_counter()
    for n, (_, sec) in run_concurrently(first, threads).items():
        times[n] = sec
    phases["results"] = time.perf_counter() - t0
    derived = {
        "headline_metrics": lambda: suite.headline().collect(),
        "reconciliation": lambda: suite.reconciliation().collect(),
        "run_manifest": lambda: suite.manifest().collect(),
        "table_fingerprint": lambda: suite.fingerprint().collect(),
    }
    for n, df in suite.datasets().items():
        derived[n] = (lambda df=df: df.collect())
    t0 = time.perf_counter()
    for n, (_, sec) in run_concurrently(derived, threads).items():
        times[n] = sec
    phases["derived"] = time.perf_counter() - t0

    # 4. The model's own tables, the panel from lifecycle specs and the dirty
    #    variant, each computed in full.
    def run(df):
        df.write.format("noop").mode("overwrite").save()
    lifecycles = lifecycle_panel(Suite(built, p))
    tables = {
        "subscription_panel": lambda: run(model.revenue),
        "churn_facts": lambda: run(model.churn),
        "customer_status": lambda: run(model.customers),
        "lifecycle_panel": lambda: run(lifecycles),
        "quality_report_dirty": lambda: quality_report(model_with_defects(model)).collect(),
        "table_counts": lambda: suite.table_counts().collect(),
    }
    t0 = time.perf_counter()
    for n, (_, sec) in run_concurrently(tables, threads).items():
        times[n] = sec
    phases["tables"] = time.perf_counter() - t0
    suite.release()
    delete_path(spark, path)

    total = sum(phases.values())
    print(json.dumps({
        "metric": "total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "phases": {k: round(v, 3) for k, v in phases.items()},
        "threads": threads,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
