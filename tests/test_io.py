"""Sources and sinks: model save/load, CSV and JSON round trips, export, the
gated runner, manifest and month helpers."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL

from arrlens.functions.months import fiscal_year, month_add, month_diff, month_spine
from arrlens.functions.measures import scaled
from arrlens.operators.quality import QualityGateError
from arrlens.plans.suite import KPI_ORDER, Suite, run_analysis
from arrlens.schema import CHURN_SCHEMA, TABLE_ORDER, Period
from arrlens.sources.orders import ORDER_DOMAINS, model_from_orders, order_period
from arrlens.sources.tables import (load_model, read_csv_table, read_json, retention_windows,
                                    save_model, table_counts, write_json, write_table)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    save_model(model_from_orders(spark, SF_SMALL, order_period(spark, SF_SMALL), checkpoint_segments=True), path)
    return path


def test_save_load_round_trip(spark, stored):
    m = load_model(spark, stored, ORDER_DOMAINS)
    counts = {r.table_name: r.row_count for r in table_counts(m).collect()}
    assert counts == {"products": 2, "customers": 150, "revenue": 8932, "churn": 3}
    months = [os.path.basename(p) for p in glob.glob(f"{stored}/revenue/revenue_month=*")]
    assert len(months) == 80
    # A single-month scan prunes to one partition folder.
    one = m.revenue.where(F.col("revenue_month") == F.lit(dt.date(1998, 12, 1)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(revenue_month" in plan
    lazy = model_from_orders(spark, SF_SMALL, order_period(spark, SF_SMALL))
    assert sorted(map(tuple, m.revenue.collect())) == sorted(map(tuple, lazy.revenue.collect()))


def test_csv_round_trip_with_empty_as_null(spark, scratch):
    rows = [("CH1", "C1", "P001", dt.date(2024, 1, 15), "x", 10, 3),
            ("CH2", "C2", None, dt.date(2024, 2, 15), None, 20, 4)]
    df = spark.createDataFrame(rows, CHURN_SCHEMA)
    p = os.path.join(scratch, "churn_csv")
    write_table(df, p, CHURN_SCHEMA.fieldNames())
    back = read_csv_table(spark, p, CHURN_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(rows, key=lambda r: r[0])
    header = open(glob.glob(p + "/*.csv")[0]).readline().strip()
    assert header == ",".join(CHURN_SCHEMA.fieldNames())


def test_csv_failfast_on_malformed(spark, scratch):
    p = os.path.join(scratch, "bad.csv")
    with open(p, "w") as f:
        f.write(",".join(CHURN_SCHEMA.fieldNames()) + "\nCH1,C1,P001,2024-01-15,x,notanumber,3\n")
    with pytest.raises(Exception):
        read_csv_table(spark, p, CHURN_SCHEMA).collect()


def test_json_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    p = write_json(df, os.path.join(scratch, "j"))
    assert sorted(map(tuple, read_json(spark, p, df.schema).collect())) == [(1, "a"), (2, "b")]
    p = write_json(spark.createDataFrame([(1, None)], "k long, v string"), os.path.join(scratch, "n"))
    rows = [json.loads(x) for f in glob.glob(p + "/*.json") for x in open(f)]
    assert rows == [{"k": 1, "v": None}]


def test_run_analysis_publishes_after_gate(spark, stored, scratch):
    m = load_model(spark, stored, ORDER_DOMAINS)
    suite = Suite(m, order_period(spark, SF_SMALL), cache_results=True)
    paths = run_analysis(suite, scratch, threads=4)
    suite.release()
    for name in KPI_ORDER:
        assert glob.glob(os.path.join(paths[name], "*.csv")), name
    head = [json.loads(x) for f in glob.glob(paths["headline_metrics"] + "/*.json") for x in open(f)]
    assert len(head) == 1 and len(head[0]) == 27
    man = [json.loads(x) for f in glob.glob(paths["run_manifest"] + "/*.json") for x in open(f)]
    by_name = {r["query_name"]: r for r in man}
    assert by_name["monthly_revenue_growth"]["row_count"] == 36
    assert by_name["quality_report"]["columns"] == ["check_name", "issue_count"]
    assert all(r["output_file"] == paths[r["query_name"]] for r in man)
    rec = [json.loads(x) for f in glob.glob(paths["reconciliation"] + "/*.json") for x in open(f)]
    assert all(r["passed"] for r in rec), [r for r in rec if not r["passed"]]
    assert len(rec) == 16 and {r["severity"] for r in rec} == {"High"} and all(r["evidence"] is not None for r in rec)
    assert os.path.exists(paths["rpt_logo_flow"])


def test_run_analysis_refuses_dirty_model(spark, stored, scratch):
    m = load_model(spark, stored, ORDER_DOMAINS)
    m.customers = m.customers.unionByName(m.customers.limit(1))
    with pytest.raises(QualityGateError):
        run_analysis(Suite(m, order_period(spark, SF_SMALL)), scratch)
    assert not os.path.exists(os.path.join(scratch, "results"))


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2025, 3, 2))], "a date, b date")
    r = df.select(month_add("a", 1).alias("x"), month_diff("a", "b").alias("d"),
                  fiscal_year("a", 3).alias("fy"), fiscal_year("a").alias("cy")).first()
    assert r.x == dt.date(2024, 2, 1) and r.d == 14 and r.fy == 2024 and r.cy == 2024
    spine = [x[0] for x in month_spine(spark, dt.date(2023, 11, 1), dt.date(2024, 2, 1)).collect()]
    assert spine == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1),
                     dt.date(2024, 2, 1)]
    w = retention_windows(spark, order_period(spark, SF_SMALL).retention_windows()).collect()
    assert [(x.year, x.start_month, x.end_month) for x in w] == [
        (1999, dt.date(1998, 12, 1), dt.date(1999, 12, 1)),
        (2000, dt.date(1999, 12, 1), dt.date(2000, 12, 1))]


def test_scaled_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(12345000,), (49996,), (-15000,), (0,)], "x long")
    got = [r[0] for r in df.select(scaled("x", dp=3)).collect()]
    assert got == [1.235, 0.005, -0.002, 0.0]


def test_period_derivations():
    p = Period(dt.date(2023, 1, 15), dt.date(2025, 12, 1), 2025)
    assert p.start == p.history_start == dt.date(2023, 1, 1) and p.n_history_months == 36
    assert p.prior_year_end == dt.date(2024, 12, 1) and p.two_years_back == dt.date(2023, 12, 1)
    assert p.year_end_day == dt.date(2025, 12, 31) and p.end_day == dt.date(2025, 12, 31)
    assert [w[0] for w in p.retention_windows()] == [2024, 2025]
    assert TABLE_ORDER[0] == "products"


def test_shared_dir_is_read_from_the_session(spark):
    """The checkpoint folder comes from the session; scratch paths live under it."""
    from arrlens.session import scratch_path, shared_dir
    base = shared_dir(spark)
    assert base
    assert spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    p = scratch_path(spark, "x")
    assert p.startswith(base) and p != scratch_path(spark, "x") and spark.sparkContext.applicationId in p


def test_shared_dir_refuses_a_driver_local_folder_on_a_cluster():
    """With no checkpoint folder named on a non-local master, no local
    fallback is made up: the call raises."""
    from types import SimpleNamespace

    from arrlens.session import shared_dir
    for master in ("yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        conf = SimpleNamespace(get=lambda key, default=None: default)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf=conf, sparkContext=sc))


def test_period_of_history():
    p = Period.of_history(dt.date(1995, 1, 3), dt.date(2001, 8, 1))
    assert (p.start, p.end, p.report_year) == (dt.date(1998, 1, 1), dt.date(2000, 12, 1), 2000)
    assert (p.history_start, p.history_end) == (dt.date(1995, 1, 1), dt.date(2001, 8, 1))
    p = Period.of_history(dt.date(2000, 3, 1), dt.date(2001, 6, 30), fy_end_month=6)
    assert (p.start, p.end, p.report_year) == (dt.date(2000, 3, 1), dt.date(2001, 6, 1), 2001)
    p = Period.of_history(dt.date(2001, 2, 1), dt.date(2001, 4, 1))
    assert (p.start, p.end, p.report_year) == (dt.date(2001, 2, 1), dt.date(2001, 4, 1), 2001)


def test_rewritten_orders_give_a_new_suite(spark, scratch):
    from arrlens.plans.registry import registry, release_shared
    for t in ("orders", "customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    counts = registry()["table_counts"]
    before = {r[0]: r[1] for r in counts(spark, scratch).collect()}
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.where("o_custkey % 2 = 0").write.mode("overwrite").parquet(f"{scratch}/orders.parquet")
    after = {r[0]: r[1] for r in counts(spark, scratch).collect()}
    release_shared()
    assert after["customers"] < before["customers"] and after["revenue"] < before["revenue"]
