"""Every registered query against its DuckDB oracle (row count, column names,
types and order-insensitive values) on the smallest driver scale."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL

import __spark_entry__ as E
from arrlens.operators.manifest import same_fingerprints, table_fingerprint
from arrlens.plans.oracle import oracle_sql
from arrlens.plans.registry import registry, release_shared, shared_suite
from arrlens.sources.orders import model_from_orders, order_period

SPARK_TO_DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN", "int": "INTEGER"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module", autouse=True)
def _release_shared_suite():
    """The registry persists one shared model per session; drop it after this
    module so later tests see fresh plans, not cached relations."""
    yield
    release_shared()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_sql())
    assert set(registry()) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 36
    assert df.columns[0] == "revenue_month"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = registry()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)
    dtypes = {r[0]: r[1] for r in duck.execute("DESCRIBE " + oracle_sql()[name]).fetchall()}
    for col, t in df.dtypes:
        assert SPARK_TO_DUCK.get(t, t) == dtypes[col], (col, t, dtypes[col])


def test_a_rebuilt_model_has_the_same_fingerprints_and_a_changed_row_is_caught(spark):
    first, again = (model_from_orders(spark, SF_SMALL, order_period(spark, SF_SMALL)) for _ in range(2))
    assert all(r.matches for r in same_fingerprints(table_fingerprint(first), table_fingerprint(again)).collect())
    revenue = again.revenue
    changed = F.when((F.col("customer_id") == "C1") & (F.col("revenue_type") == "New"), 1).otherwise(0)
    again.revenue = revenue.withColumn("closing_mrr_inr", F.col("closing_mrr_inr") + changed)
    got = {r.table_name: r.matches for r in same_fingerprints(table_fingerprint(first), table_fingerprint(again)).collect()}
    assert got == {"products": True, "customers": True, "revenue": False, "churn": True}


def test_other_fiscal_years_agree_with_the_oracle(spark, duck):
    """With a June year end all metrics still equal the oracle's and each other."""
    from arrlens.plans.suite import KPI_ORDER
    suite = shared_suite(spark, SF_SMALL, order_period(spark, SF_SMALL, 6))
    assert suite.period.report_year == 2001 and suite.period.end == datetime.date(2001, 6, 1)
    for name in KPI_ORDER[1:]:
        df = suite.kpi(name)
        cur = duck.execute(oracle_sql(6)[name])
        cols = [d[0] for d in cur.description]
        assert _canon(df.columns, map(tuple, df.collect())) == _canon(cols, cur.fetchall()), name
    rows = suite.reconciliation().collect()
    assert [r.check_name for r in rows if not r.passed] == []


def test_expected_values_are_checked(spark):
    suite = shared_suite(spark, SF_SMALL)
    counts = {r[0]: r[1] for r in suite.table_counts().collect()}
    gq = suite.kpi("growth_quality").where(F.col("year") == suite.period.report_year).first()
    flow = (gq.new_customers, gq.permanently_churned_customers)
    right = {"table_counts": counts, "customer_flow": flow, "growth_quality": {"ending_arr_inr": gq.ending_arr_inr}}
    wrong = {"table_counts": counts | {"churn": -1}, "customer_flow": (flow[0] + 1, flow[1]),
             "growth_quality": {"new_customers": gq.new_customers + 1}}
    for expected, failed in ((right, set()), (wrong, {"expected_table_volumes", "customer_flow_totals",
                                                      "growth_quality_ties_to_kpis", "overall_verdict"})):
        suite._cache.pop("reconciliation", None)
        rows = suite.reconciliation(expected).collect()
        suite._cache.pop("reconciliation", None)
        assert {r.check_name for r in rows if not r.passed} == failed
        assert {r.check_name: r.severity for r in rows}["expected_table_volumes"] == "Medium"


def test_reconciliation_identities_hold_on_the_derived_model(spark):
    """Agreement with the oracle is not enough: every cross-metric identity
    must also pass on the order-derived model."""
    rows = registry()["reconciliation"](spark, SF_SMALL).collect()
    assert len(rows) == 16
    assert [r.check_name for r in rows if not r.passed] == []
