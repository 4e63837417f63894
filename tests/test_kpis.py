"""KPI semantics on a hand-made seven-customer model, one case per trap, plus
dirty-data checks that drive every quality and constraint count above zero."""

import datetime as dt

import pytest

from arrlens.operators import kpis as K
from arrlens.operators.quality import QualityGateError, assert_quality, constraint_report, quality_report
from arrlens.plans.suite import Suite
from arrlens.schema import (CHURN_SCHEMA, CUSTOMERS_SCHEMA, REVENUE_SCHEMA, Domains, Model,
                            Period, add_months)
from arrlens.sources.tables import products_table

P = Period(dt.date(2023, 1, 1), dt.date(2024, 12, 1), 2024)
SEGMENTS = ("S1", "S2")


def months(a, b):
    out, m = [], a
    while m <= b:
        out.append(m)
        m = add_months(m, 1)
    return out


def rev_rows(cid, pid, spans):
    """spans: list of (first, last, closing, first_type, opening)."""
    rows = []
    for first, last, closing, ftype, opening in spans:
        for m in months(first, last):
            t, o = (ftype, opening) if m == first else ("Recurring", closing)
            rows.append((f"R{cid}-{m:%Y%m}", m, cid, pid, t, o, closing - o, closing, closing,
                         closing * 12))
    return rows


D = dt.date


def half_up(x, dp):
    """SQL ROUND semantics (half away from zero), unlike Python's round()."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-dp), rounding=ROUND_HALF_UP))


def tiny_rows():
    cust = [
        # id, name, industry, segment, region, channel, owner, signup, first, init, cur, status
        ("C1", "n1", "i", "S1", "r", "A", "O1", D(2022, 6, 1), D(2022, 6, 1), "P001", "P001", "Active"),
        ("C2", "n2", "i", "S1", "r", "A", "O1", D(2022, 1, 1), D(2022, 1, 1), "P001", "P001", "Active"),
        ("C3", "n3", "i", "S2", "r", "A", "O2", D(2022, 1, 1), D(2022, 1, 1), "P001", "P001", "Active"),
        ("C4", "n4", "i", "S2", "r", "B", "O2", D(2024, 5, 1), D(2024, 5, 1), "P002", "P002", "Active"),
        ("C5", "n5", "i", "S2", "r", "B", "O2", D(2024, 2, 1), D(2024, 2, 1), "P001", "P001", "Active"),
        ("C6", "n6", "i", "S1", "r", "B", "O1", D(2021, 1, 1), D(2021, 1, 1), "P002", "P002", "Churned"),
        ("C7", "n7", "i", "S1", "r", "B", "O1", D(2022, 3, 1), D(2022, 3, 1), "P002", "P002", "Churned"),
    ]
    rev = []
    # Out-of-window Upgrade row (T11, T12), recurring, expansion in 2024-03.
    rev.append(("RC1-202212", D(2022, 12, 1), "C1", "P001", "Upgrade", 90, 10, 100, 100, 1200))
    rev += rev_rows("C1", "P001", [(D(2023, 1, 1), D(2024, 2, 1), 100, "Recurring", 100),
                                   (D(2024, 3, 1), D(2024, 12, 1), 150, "Expansion", 100)])
    # Paused at the end month.
    rev += rev_rows("C2", "P001", [(D(2023, 1, 1), D(2024, 11, 1), 200, "Recurring", 200)])
    # Paused at the cohort start month, reactivated in 2024-02.
    rev += rev_rows("C3", "P001", [(D(2023, 1, 1), D(2023, 10, 1), 300, "Recurring", 300),
                                   (D(2024, 2, 1), D(2024, 12, 1), 300, "Reactivation", 0)])
    # C4: new in the report year.
    rev += rev_rows("C4", "P002", [(D(2024, 5, 1), D(2024, 12, 1), 400, "New", 0)])
    # No revenue at all (T9). C6: churned before the window.
    # Churned in 2024-06.
    rev += rev_rows("C7", "P002", [(D(2023, 1, 1), D(2024, 5, 1), 500, "Recurring", 500)])
    churn = [("CH6", "C6", "P002", D(2022, 11, 15), "Budget", 250, 22),
             ("CH7", "C7", "P002", D(2024, 6, 15), "Price", 500, 27)]
    return cust, rev, churn


def make_model(spark, cust, rev, churn):
    return Model(customers=spark.createDataFrame(cust, CUSTOMERS_SCHEMA),
                 products=products_table(spark),
                 revenue=spark.createDataFrame(rev, REVENUE_SCHEMA),
                 churn=spark.createDataFrame(churn, CHURN_SCHEMA),
                 domains=Domains(segments=SEGMENTS))


@pytest.fixture(scope="module")
def tiny(spark):
    return make_model(spark, *tiny_rows())


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_executive_kpis(tiny):
    k = one(K.executive_kpis(tiny, P))
    assert k["ending_mrr_inr"] == 150 + 300 + 400
    assert k["ending_arr_inr"] == 850 * 12
    assert k["ending_active_customers"] == 3
    assert k["new_customers"] == 1 and k["new_arr_inr"] == 4800
    assert k["expansion_arr_inr"] == 600
    assert k["upgrade_arr_inr"] == 0
    assert k["reactivated_arr_inr"] == 3600
    # Cohort at 2023-12: C1 100, C2 200, C7 500 (C3 paused, C4 not yet).
    assert k["nrr_pct"] == half_up(100.0 * 150 / 800, 1)
    assert k["grr_pct"] == half_up(100.0 * 100 / 800, 1)
    # 2022-12 base: C1's out-of-window row.
    assert k["two_year_mrr_growth_pct"] == 750.0
    in_window = sum(r[8] for r in tiny_rows()[1] if r[1] >= P.start)
    assert k["total_revenue_inr"] == in_window


def test_retention_pause_traps(tiny):
    r = {x.year: x for x in K.annual_retention(tiny, P).collect()}
    assert list(r) == [2024]          # no 2022-12 cohort inside the window (T22)
    y = r[2024]
    assert (y.starting_customers, y.retained_customers) == (3, 1)     # T16, T17
    assert (y.starting_mrr_inr, y.ending_mrr_same_cohort_inr) == (800, 150)
    assert y.logo_retention_pct == 33.3


def test_channel_left_join_and_churn_traps(tiny):
    c = {x.acquisition_channel: x for x in K.channel_performance(tiny, P).collect()}
    b = c["B"]
    assert b.acquired_customers == 4                      # C5 has no revenue (T9)
    # By contract date: C4 and C5 (C5 never billed); Q02 counts only C4.
    assert b.new_customers == 2
    assert b.permanently_churned_customers == 2           # C6 churned before the window (T15)
    assert b.observed_logo_churn_pct == 50.0
    assert b.recognized_revenue_inr == 8 * 400 + 17 * 500
    assert b.active_customers_at_end == 1 and b.avg_arr_per_active_customer_inr == 4800.0
    a = c["A"]
    # All-time recognized revenue includes the 2022-12 row.
    assert a.recognized_revenue_inr == 100 + 14 * 100 + 10 * 150 + 23 * 200 + 21 * 300
    assert a.ending_arr_inr == (150 + 300) * 12


def test_plan_segment_excludes_out_of_window(tiny):
    rows = K.plan_segment_performance(tiny, P).collect()
    total = sum(r.recognized_revenue_inr for r in rows)
    assert total == sum(r[8] for r in tiny_rows()[1] if r[1] >= P.start)
    assert round(sum(r.ending_arr_mix_pct for r in rows)) == 100


def test_sales_owner_upgrade_events_all_time(tiny):
    o = {x.sales_owner: x for x in K.sales_owner_performance(tiny, P).collect()}
    assert o["O1"].upgrade_events == 1                    # 2022-12 upgrade counts (T12)
    assert o["O1"].expansion_upgrade_arr_inr == 600       # only report-year events


def test_churn_reasons_window(tiny):
    rows = K.churn_reasons(tiny, P).collect()
    assert [(r.churn_reason, r.churned_customers, r.lost_arr_mix_pct) for r in rows] == [
        ("Price", 1, 100.0)]


def test_customer_flow_net_change_is_not_new_minus_churn(tiny):
    f = {x.revenue_month: x for x in K.customer_flow(tiny, P).collect()}
    assert f[D(2023, 1, 1)].net_active_customer_change is None
    m = f[D(2024, 6, 1)]          # C7 churns: active 5 -> 4 (C1, C2, C3, C4)
    assert m.permanently_churned_customers == 1
    assert m.net_active_customer_change == -1
    assert m.net_new_minus_permanent_churn == -1
    assert f[D(2024, 12, 1)].net_active_customer_change == -1     # C2 pauses (T21)
    assert f[D(2024, 12, 1)].net_new_minus_permanent_churn == 0


def test_growth_quality_rounding_traps(tiny):
    g = {x.year: x for x in K.growth_quality(tiny, P).collect()}
    y23, y24 = g[2023], g[2024]
    assert y23.avg_arr_per_active_customer_inr == round(12.0 * 800 / 3)
    g_arr = 100.0 * (y24.ending_arr_inr - y23.ending_arr_inr) / y23.ending_arr_inr
    g_act = 100.0 * (y24.active_customers - y23.active_customers) / y23.active_customers
    assert y24.arr_growth_minus_customer_growth_pp == half_up(g_arr - g_act, 1)          # T19
    avg_g = 100.0 * (y24.avg_arr_per_active_customer_inr - y23.avg_arr_per_active_customer_inr) \
        / y23.avg_arr_per_active_customer_inr
    assert y24.yoy_avg_arr_per_customer_growth_pct == half_up(avg_g, 1)                  # T18
    assert y24.permanently_churned_customers == 1


def test_missing_month_shifts_row_lag(spark):
    """LAG(12) counts rows, not months (T7): with 2023-05 missing, 2024-01 has
    no value yet and 2024-02 is compared with 2023-01, thirteen months back."""
    cust, _, _ = tiny_rows()
    rev = [r for r in rev_rows("C1", "P001", [(D(2023, 1, 1), D(2024, 12, 1), 100, "New", 0)])
           if r[1] != D(2023, 5, 1)]
    rev += [("RC2-202402", D(2024, 2, 1), "C2", "P001", "New", 0, 50, 50, 50, 600)]
    m = make_model(spark, cust, rev, [])
    rows = K.monthly_revenue_growth(m, P).collect()
    assert len(rows) == 23
    yoy = {r.revenue_month: r.yoy_mrr_growth_pct for r in rows}
    assert yoy[D(2024, 1, 1)] is None
    assert yoy[D(2024, 2, 1)] == 50.0
    assert yoy[D(2024, 3, 1)] == 0.0


def test_empty_report_year_gives_nulls_not_errors(spark):
    """No row in the report year -> SUM is null, COUNT is 0, and
    every ratio with a zero/empty denominator is null (ANSI mode on)."""
    cust, _, _ = tiny_rows()
    rev = rev_rows("C1", "P001", [(D(2023, 1, 1), D(2023, 6, 1), 100, "New", 0)])
    m = make_model(spark, cust, rev, [])
    k = one(K.executive_kpis(m, P))
    assert k["new_customers"] == 0
    assert k["new_arr_inr"] is None
    assert k["expansion_arr_inr"] is None
    assert k["ending_mrr_inr"] is None
    assert k["nrr_pct"] is None and k["two_year_mrr_growth_pct"] is None
    assert K.annual_retention(m, P).count() == 0
    assert K.churn_reasons(m, P).count() == 0


def test_clean_tiny_model_passes_reconciliation(spark, tiny):
    s = Suite(tiny, P)
    rec = {r.check_name: r.passed for r in s.reconciliation().collect()}
    # The tiny model has deliberate traps (an upgrade row before the window).
    assert rec["ending_arr_reconciled"] and rec["channel_subtotals"]
    assert rec["plan_segment_subtotals"] and rec["nrr_grr_recomputed"]
    assert rec["post_sale_growth_reconciled"] and rec["segment_subtotals"]
    assert rec["growth_quality_ties_to_kpis"] and rec["customer_flow_totals"]
    assert rec["period_coverage"] is False          # the 2022-12 row widens coverage
    assert rec["overall_verdict"] is False


def test_quality_report_clean(tiny):
    q = {r.check_name: r.issue_count for r in quality_report(tiny).collect()}
    assert len(q) == 9 and set(q.values()) == {0}
    assert_quality(quality_report(tiny))


def test_dirty_data_raises_every_check(spark):
    cust, rev, churn = tiny_rows()
    cust = cust + [cust[0]]                                                     # D1
    cust = cust + [("C9", "n9", "i", "SMB", "r", "A", "O1", D(2023, 1, 1), D(2023, 1, 1),
                    "P404", None, "Paused")]                                     # D9, C3, C4, C5
    rev = rev + [rev[1]]                                                        # D2 (same key)
    rev = rev + [("RX-1", D(2023, 1, 1), "C99", "P999", "Other", -1, 0, 0, 0, 1)]  # D3 D4 D6 C5 C6
    churn = churn + [("CH3", "C3", "P001", D(2024, 1, 15), "x", 0, 0),          # D7 D8 C6
                     ("CH8", "C98", "P001", D(2024, 1, 15), "x", 1, 1)]          # D5
    m = make_model(spark, cust, rev, churn)
    q = {r.check_name: r.issue_count for r in quality_report(m).collect()}
    assert q == {"duplicate_customer_id": 1, "duplicate_customer_month": 1,
                 "orphan_revenue_customer": 1, "orphan_revenue_product": 1,
                 "orphan_churn_customer": 1, "invalid_arr_math": 1,
                 "reactivated_customer_in_churn": 1, "churn_status_mismatch": 1,
                 "smb_records": 1}
    with pytest.raises(QualityGateError):
        assert_quality(quality_report(m))
    c = {r.check_name: r.issue_count for r in constraint_report(m).collect()}
    assert c["pk_unique_customers"] == 1 and c["pk_unique_revenue"] == 1
    assert c["unique_revenue_month_customer"] == 1
    assert c["fk_customers_initial_product_id"] == 1
    assert c["fk_customers_current_product_id"] == 0          # null FK is not a violation
    assert c["fk_revenue_customer_id"] == 1 and c["fk_revenue_product_id"] == 1
    assert c["fk_churn_customer_id"] == 1
    assert c["not_null_customers"] == 1
    assert c["enum_revenue_type"] == 1 and c["enum_company_segment"] == 1
    assert c["enum_lifecycle_status"] == 1
    assert c["domain_revenue_opening_mrr_inr"] == 1 and c["domain_revenue_closing_mrr_inr"] == 1
    assert c["domain_churn_mrr_lost_inr"] == 1 and c["domain_churn_tenure_months"] == 1
    assert c["arr_math"] == 1 and c["waterfall_math"] == 1
    assert c["pk_unique_products"] == 0 and c["enum_plan_tier"] == 0


def test_rule_chosen_defects_trip_every_check(spark):
    """The registered dirty variant: defects chosen by value over the whole
    order-derived model make all nine checks non-zero, and the gate raises."""
    import __spark_entry__ as E
    from paths import SF_MID
    from arrlens.plans.registry import release_shared
    try:
        df = E.queries()["quality_report_dirty"](spark, SF_MID)
        q = {r.check_name: r.issue_count for r in df.collect()}
        assert len(q) == 9 and all(v > 0 for v in q.values()), q
        with pytest.raises(QualityGateError):
            assert_quality(df)
    finally:
        release_shared()
