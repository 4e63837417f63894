"""How a model is stored: published snapshots, incremental refresh, buckets."""

import datetime as dt
import glob
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL

from arrlens.operators import kpis as K
from arrlens.operators.manifest import differences, fingerprint_tree, month_digests, same_fingerprints, table_fingerprint
from arrlens.operators.quality import QualityGateError, assert_quality, quality_report
from arrlens.plans.suite import ReconciliationError, Suite, run_analysis
from arrlens.schema import Period
from arrlens.sources import tables as T
from arrlens.sources.bucketed import load_bucketed, register_bucketed, save_bucketed
from arrlens.sources.orders import ORDER_DOMAINS, model_from_orders, order_period
from arrlens.sources.refresh import refresh_model
from arrlens.sources.snapshots import read_pointer, remove_unpublished
from arrlens.sources.tables import load_model, save_model

TABLES = ("orders", "customer", "nation", "region")


def _model(spark, sf_dir=SF_SMALL, period=None):
    return model_from_orders(spark, sf_dir, period or order_period(spark, sf_dir), checkpoint_segments=True)


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/revenue/*/*/*.parquet")}


def _equal(a, b):
    return all(r.matches for r in same_fingerprints(table_fingerprint(a), table_fingerprint(b)).collect())


@pytest.fixture(scope="module")
def halves(spark, tmp_path_factory):
    """Folders with the orders before a day, and with all of them; and the later ones."""
    root = str(tmp_path_factory.mktemp("orders"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")

    def folder(name, rows):
        for t in TABLES[1:]:
            spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{root}/{name}/{t}.parquet")
        rows.write.parquet(f"{root}/{name}/orders.parquet")
        return f"{root}/{name}"
    late = (F.col("o_orderdate") >= F.lit(dt.datetime(2001, 5, 10)).cast("timestamp_ntz")) | (F.col("o_orderkey") % 97 == 3)
    return folder("before", orders.where(~late)), folder("after", orders), orders.where(late)


def test_a_refresh_equals_a_full_rebuild_and_leaves_other_months_alone(spark, halves, scratch):
    before, after, appended = halves
    old_period, period = order_period(spark, before), order_period(spark, after)
    assert old_period.history_end < period.history_end
    path = save_model(_model(spark, before), f"{scratch}/m")
    files = _files(path)
    months = refresh_model(spark, path, after, appended, old_period, period,
                           check=lambda m: assert_quality(quality_report(m)))
    got, want = load_model(spark, path, ORDER_DOMAINS), _model(spark, after)
    assert _equal(got, want)
    assert differences(month_digests(got.revenue), month_digests(want.revenue)).count() == 0
    # Bitmaps of old and new numbers still count customers exactly.
    exact = {r.revenue_month: r.n for r in got.revenue.groupBy("revenue_month").agg(F.count_distinct("customer_id").alias("n")).collect()}
    assert {r.revenue_month: r.active_customers for r in K.month_facts(got).collect()} == exact
    pointer = read_pointer(spark, path)
    untouched = set(pointer["months"]) - {str(m) for m in months}
    kept = [f for f in files if re.search("revenue_month=([0-9-]+)", f)[1] in untouched]
    assert kept and {f: _files(path).get(f) for f in kept} == {f: files[f] for f in kept}
    assert len({pointer["months"][m] for m in untouched}) == 1 and months


def test_a_refresh_within_the_history_rebuilds_only_customers_with_new_orders(spark, scratch, tmp_path):
    from arrlens.sources.refresh import changed_customers
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    one = orders.where("o_orderdate >= '1999-01-01'").orderBy("o_orderkey").limit(1).cache()
    key = one.first()
    for t in TABLES[1:]:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    orders.where(F.col("o_orderkey") != key.o_orderkey).write.parquet(f"{tmp_path}/orders.parquet")
    period = order_period(spark, SF_SMALL)
    path = save_model(_model(spark, str(tmp_path), period), f"{scratch}/m")
    old = load_model(spark, path, ORDER_DOMAINS)
    assert [r.customer_key for r in changed_customers(old, one, period.history_end, period).collect()] == [key.o_custkey]
    months = refresh_model(spark, path, SF_SMALL, one, period, period)
    assert _equal(load_model(spark, path, ORDER_DOMAINS), _model(spark, SF_SMALL, period))
    assert all(m >= dt.date(key.o_orderdate.year, key.o_orderdate.month, 1) for m in months) and len(months) < 40
    # Nothing appended: nothing is written again.
    assert refresh_model(spark, path, SF_SMALL, one.limit(0), period, period) == []


def test_readers_see_the_old_model_until_a_save_is_whole(spark, scratch, monkeypatch):
    path = save_model(_model(spark), f"{scratch}/m")
    before = load_model(spark, path, ORDER_DOMAINS)
    counts = {r.table_name: r.row_count for r in T.table_counts(before).collect()}
    other = _model(spark)
    other.customers, other.numbered = other.customers.limit(10), other.numbered.limit(50)
    write = T._write_one

    def killed(model, name, *rest):
        if name == "churn":
            raise KeyboardInterrupt  # the third table of four
        write(model, name, *rest)
        seen = {r.table_name: r.row_count for r in T.table_counts(load_model(spark, path)).collect()}
        assert seen == counts  # a reader beside the running save
    monkeypatch.setattr(T, "_write_one", killed)
    with pytest.raises(KeyboardInterrupt):
        save_model(other, path)
    monkeypatch.undo()
    assert {r.table_name: r.row_count for r in T.table_counts(load_model(spark, path)).collect()} == counts
    assert {r.table_name: r.row_count for r in T.table_counts(before).collect()} == counts
    pointer = read_pointer(spark, path)
    assert remove_unpublished(spark, path) and read_pointer(spark, path) == pointer
    assert {r.table_name: r.row_count for r in T.table_counts(load_model(spark, path)).collect()} == counts
    assert remove_unpublished(spark, path) == []


def test_a_load_that_fails_its_check_publishes_nothing(spark, scratch):
    def gate(model):
        assert_quality(quality_report(model))
    path = f"{scratch}/m"
    bad = _model(spark)
    bad.customers = bad.customers.unionByName(bad.customers.limit(1))
    with pytest.raises(QualityGateError):
        save_model(bad, path, check=gate)
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    save_model(_model(spark), path, check=gate)
    assert load_model(spark, path).customers.count() > 0
    with pytest.raises(FileExistsError):
        save_model(_model(spark), path, mode="error")


def test_an_empty_model_is_saved_and_loaded(spark, scratch):
    m = _model(spark)
    for t in ("customers", "revenue", "churn", "numbered"):
        setattr(m, t, getattr(m, t).limit(0))
    back = load_model(spark, save_model(m, f"{scratch}/m"))
    assert back.revenue.count() == back.customers.count() == 0 and back.revenue.columns == m.revenue.columns
    assert K.month_facts(back).count() == 0


def test_a_changed_row_is_located_to_its_month(spark):
    a = _model(spark)
    b = _model(spark)
    month = dt.date(1999, 4, 1)
    first = F.col("revenue_id") == a.revenue.where(F.col("revenue_month") == F.lit(month)).agg(F.min("revenue_id")).first()[0]
    b.revenue = b.revenue.withColumn("closing_mrr_inr", F.col("closing_mrr_inr") + F.when(first, 1).otherwise(0))
    assert [r.part for r in differences(month_digests(a.revenue), month_digests(b.revenue)).collect()] == [str(month)]
    tree_a, tree_b = ({(r.level, r.name, r.part): tuple(r)[3:] for r in fingerprint_tree(m).collect()} for m in (a, b))
    assert {k for k in tree_a if tree_a[k] != tree_b[k]} == {("month", "revenue", str(month)), ("table", "revenue", None),
                                                              ("model", "model", None)}


def test_a_negative_verdict_publishes_nothing(spark, scratch):
    period = order_period(spark, SF_SMALL)
    m = load_model(spark, save_model(_model(spark), f"{scratch}/m"), ORDER_DOMAINS)
    with pytest.raises(ReconciliationError, match="expected_table_volumes"):
        run_analysis(Suite(m, period, cache_results=True), f"{scratch}/out", {"table_counts": {"customers": 1}}, threads=2)
    assert [f for f in os.listdir(f"{scratch}/out")] == []
    paths = run_analysis(Suite(m, period, cache_results=True), f"{scratch}/out", threads=2)
    run = json.load(open(f"{scratch}/out/_current.json"))["run"]
    assert all(p.startswith(f"{scratch}/out/{run}/") and os.path.isdir(p) for p in paths.values())
    assert sorted(os.listdir(f"{scratch}/out")) == sorted([run, "_current.json"] + [f for f in os.listdir(f"{scratch}/out") if f.endswith(".crc")])


def test_counts_of_the_write_equal_the_manifest(spark, scratch):
    period = order_period(spark, SF_SMALL)
    suite = Suite(load_model(spark, save_model(_model(spark), f"{scratch}/m"), ORDER_DOMAINS), period, cache_results=True)
    paths = run_analysis(suite, f"{scratch}/out", threads=2)
    rows = [json.loads(x) for f in glob.glob(paths["run_manifest"] + "/*.json") for x in open(f)]
    want = {r.query_name: (r.row_count, r.column_names.split(",")) for r in suite.manifest().collect()}
    assert {r["query_name"]: (r["row_count"], r["columns"]) for r in rows} == want


def test_large_results_stay_spread_over_files(spark, scratch):
    path, rows = T.export_observed(spark.range(0, 4000, 1, 4), f"{scratch}/r")
    assert rows == 4000 and len(glob.glob(f"{path}/*.csv")) == 4


@pytest.fixture(scope="module")
def buckets(spark, tmp_path_factory):
    """A model, and the same from a session's catalog that had to learn of its files anew."""
    m, path = _model(spark), str(tmp_path_factory.mktemp("buckets"))
    save_bucketed(m, path, "arrlens_test", buckets=4)
    assert _equal(load_bucketed(spark, "arrlens_test", ORDER_DOMAINS), m)
    for t in T.TABLE_ORDER:
        spark.sql(f"DROP TABLE arrlens_test_{t}")
    register_bucketed(spark, path, "arrlens_again")
    return m, load_bucketed(spark, "arrlens_again", ORDER_DOMAINS)


def test_registered_tables_hold_the_whole_model(buckets):
    assert _equal(*buckets)


def test_unions_of_bucketed_tables_are_grouped_whole(spark, buckets):
    from arrlens.operators.quality import quality_report
    from arrlens.sources.orders import model_with_defects
    got, want = ([tuple(r) for r in quality_report(model_with_defects(m)).collect()] for m in (buckets[1], buckets[0]))
    assert got == want
    both = buckets[1].customers.unionByName(buckets[1].customers)
    assert both.groupBy("customer_id").count().count() == buckets[1].customers.count()


def test_a_suite_on_bucketed_tables_reconciles(spark, buckets):
    suite = Suite(buckets[1], order_period(spark, SF_SMALL), cache_results=True)
    assert all(r.passed for r in suite.reconciliation().collect())


BY_CUSTOMER = {"executive_kpis": K.executive_kpis, "annual_retention": K.annual_retention, "account_facts": K.account_facts,
               "channel_performance": K.channel_performance, "sales_owner_performance": K.sales_owner_performance,
               "segment_churn_retention": K.segment_churn_retention, "plan_segment_performance": K.plan_segment_performance}


@pytest.mark.parametrize("name", BY_CUSTOMER)
def test_bucketed_tables_meet_by_customer_without_an_exchange(spark, buckets, name):
    lazy, stored = buckets
    period: Period = order_period(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:  # as on tables that are too large to broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = BY_CUSTOMER[name](stored, period)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not re.findall(r"Exchange hashpartitioning\([^)]*customer_id", plan)
        assert "Bucketed: true" in plan
        number = [c for c in got.columns if c != "customer_no"]
        assert sorted(map(str, got.select(number).collect())) == sorted(map(str, BY_CUSTOMER[name](lazy, period).select(number).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
