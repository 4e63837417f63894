"""Plan properties every registered query must keep at any scale."""

import re

import pytest

from paths import SF_SMALL

from arrlens.plans.registry import registry

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas"]
AGG = re.compile(r"(HashAggregate|SortAggregate|ObjectHashAggregate)")
SCAN = re.compile(r"(FileScan|Scan parquet|Scan ExistingRDD|InMemoryTableScan)")


def _single_partition_inputs_are_aggregated(plan: str) -> list[str]:
    """For each `Exchange SinglePartition`, the first data-producing node
    below it must be an aggregate (or a literal table), never a table scan."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        for nxt in lines[i + 1:]:
            d = len(nxt) - len(nxt.lstrip(" :+-"))
            if d <= depth:
                break
            if AGG.search(nxt) or "LocalTableScan" in nxt:
                break
            if SCAN.search(nxt):
                bad.append(line.strip())
                break
    return bad


@pytest.mark.parametrize("name", sorted(registry()))
def test_plan_shape(spark, name):
    # Unshared registry: the full plan of each query, not a cached leaf.
    df = registry(shared=False)[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan]
    # Orders are never read whole: status and the unused columns are pruned.
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert "o_orderstatus" not in schema and "o_comment" not in schema
    assert not _single_partition_inputs_are_aggregated(plan)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_results_of_a_suite_read_the_fact_once(spark):
    """Month- and customer-grain results are made from the suite's two fact
    tables, without another scan of the revenue table."""
    from arrlens.operators import kpis as K
    from arrlens.plans.registry import shared_suite
    suite = shared_suite(spark, SF_SMALL)
    m, p = suite.model, suite.period
    assert "revenue_month" in _plan(K.month_facts(m)) and "FileScan parquet" in _plan(K.month_facts(m))
    for f in (K.monthly_revenue_growth, K.growth_event_bridge, K.customer_flow, K.growth_quality):
        plan = _plan(f(m, p, months=suite.months()))
        assert "movement_mrr_inr" not in plan and "closing_mrr_inr" not in plan, f.__name__
    for f in (K.channel_performance, K.plan_segment_performance, K.sales_owner_performance, K.segment_churn_retention):
        plan = _plan(f(m, p, accounts=suite.accounts()))
        assert "movement_mrr_inr" not in plan and "closing_mrr_inr" not in plan, f.__name__


def test_constraints_copy_no_row(spark):
    from arrlens.plans.registry import suite_for
    assert "Expand" not in _plan(suite_for(spark, SF_SMALL, shared=False).constraints())


def test_lifecycle_panel_sweeps_a_customer_once(spark):
    """One exchange by customer beside the reduction by (customer, month), the
    segments' own two and the plans' few rows; buffers of a fixed width."""
    plan = _plan(registry(shared=False)["lifecycle_panel"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+, \d", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+, ym#", plan)) == 1
    assert "SortAggregate" not in plan
    assert not re.search(r"SortMergeJoin \[[^]]*customer", plan)  # only the plans' few rows are joined so


def test_distinct_customers_travel_as_bitmaps(spark):
    from arrlens.operators.kpis import month_facts, plan_segment_performance
    from arrlens.plans.registry import shared_suite
    suite = shared_suite(spark, SF_SMALL)
    plan = _plan(month_facts(suite.model))
    assert "bitmap_construct_agg" in plan
    # What is exchanged is a row for each month and bitmap, never a customer.
    exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanged and not any("customer_id" in x for x in exchanged)
    plan = _plan(plan_segment_performance(suite.model, suite.period, accounts=suite.accounts()))
    assert "bitmap_construct_agg" in plan


def test_checks_of_a_suite_scan_each_table_once_for_rows_and_once_for_keys(spark):
    from arrlens.plans.registry import shared_suite
    suite = shared_suite(spark, SF_SMALL)
    from arrlens.operators.quality import constraint_report, quality_report
    months, accounts = suite.months(), suite.accounts()
    plan = _plan(constraint_report(suite.model, months, accounts))
    assert len(re.findall(r"FileScan parquet .*revenue_id", plan)) == 2  # row rules, and the primary key
    plan = _plan(quality_report(suite.model, months, accounts))
    assert "revenue_id" not in plan and "arr_run_rate_inr" not in plan and "revenue_type" not in plan


def test_stored_panel_travels_without_texts(spark, scratch, monkeypatch):
    """save_model exchanges and sorts what the panel's rows are made from; sums of
    months need no sorted rows."""
    from arrlens.operators.kpis import month_facts
    from arrlens.sources import tables
    from arrlens.sources.orders import model_from_orders, order_period
    model = model_from_orders(spark, SF_SMALL, order_period(spark, SF_SMALL))
    written = []
    monkeypatch.setattr(tables, "write_revenue", lambda rows, path, snapshot, by="customer_id", made=lambda rows: rows: written.append((rows, by, made)))
    tables._write_one(model, "revenue", scratch, "s")
    rows, by, made = written[0]
    assert by == "customer_key" and "revenue_id" not in rows.columns and "customer_id" not in rows.columns
    assert made(rows).columns == model.numbered.columns
    assert made(rows).exceptAll(model.numbered).count() == 0 and rows.count() == model.numbered.count()
    # Sorted rows, for the bitmaps, have two columns.
    plan = _plan(month_facts(model))
    assert not re.search(r"SortAggregate\([^\n]*partial_sum\([^\n]*mrr", plan)
