"""Panel builder: survey anchor counts, and a brute-force property test of the
segment algorithm against a direct month-by-month expansion."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import SF_MID, SF_SMALL

from arrlens.operators.panel import (churn_facts, contract_months, customer_lifecycle,
                                     expand_panel, lifecycle_segments)
from arrlens.schema import Period
from arrlens.sources.orders import model_from_orders, order_events, order_period, read

EVENT_SCHEMA = T.StructType([
    T.StructField("customer_key", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("event_key", T.LongType()),
    T.StructField("mrr", T.LongType()),
    T.StructField("reason", T.StringType()),
])


@pytest.mark.parametrize("sf,rows,types,churn,customers", [
    (SF_SMALL, 4250, {"Recurring": 4006, "New": 34, "Expansion": 59, "Upgrade": 47,
                      "Reactivation": 104}, 16, 150),
    (SF_MID, 41973, {"Recurring": 39373, "New": 317, "Expansion": 724, "Upgrade": 495,
                     "Reactivation": 1064}, 198, 1491),
])
def test_anchor_counts(spark, sf, rows, types, churn, customers):
    # A window given by hand is also the history, so later orders are left out.
    m = model_from_orders(spark, sf, Period(datetime.date(1996, 1, 1), datetime.date(1998, 12, 1), 1998))
    got = {r[0]: r[1] for r in m.revenue.groupBy("revenue_type").count().collect()}
    assert sum(got.values()) == rows
    assert got == types
    assert m.churn.count() == churn
    assert m.customers.count() == customers
    assert m.revenue.select("revenue_month").distinct().count() == 36


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_no_order_is_left_out(spark, sf):
    """Every customer that ordered is in the model, every order month has
    revenue, and all-time metrics differ from those of the window."""
    period = order_period(spark, sf)
    m = model_from_orders(spark, sf, period)
    orders = read(spark, sf, "orders")
    assert m.customers.count() == orders.select("o_custkey").distinct().count()
    signed = orders.select(F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
                           F.trunc("o_orderdate", "MM").alias("revenue_month")).distinct()
    assert signed.join(m.revenue, ["customer_id", "revenue_month"], "left_anti").count() == 0
    window = m.revenue.where(F.col("revenue_month").between(F.lit(period.start), F.lit(period.end)))
    both = [x.agg(F.sum("recognized_revenue_inr"), F.count_if(F.col("revenue_type") == "Upgrade")).first()
            for x in (m.revenue, window)]
    assert both[0][0] > both[1][0] and both[0][1] > both[1][1]


def test_contract_months_aggregate_by_hash(spark):
    events = order_events(read(spark, SF_SMALL, "orders"))
    plan = contract_months(events, order_period(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def brute_force(events, period, thr, term=12):
    """Direct expansion: every contract covers `term` months; closing = max
    MRR signed so far; type from the previous active month."""
    by_c = {}
    for ck, ts, _, mrr, _ in events:
        ym = ts.year * 12 + ts.month - 1
        if ym > period.last_index:
            continue
        by_c.setdefault(ck, {}).setdefault(ym, 0)
        by_c[ck][ym] = max(by_c[ck][ym], mrr)
    rows = {}
    for ck, months in by_c.items():
        active = sorted({m + k for m in months for k in range(term) if m + k <= period.last_index})
        closing, prev_m, prev_c = None, None, None
        for m in active:
            if m in months:
                closing = months[m] if closing is None else max(closing, months[m])
            tier = "Enterprise" if closing >= thr else "Professional"
            if prev_m is None:
                t = "New"
            elif prev_m < m - 1:
                t = "Reactivation"
            elif tier == "Enterprise" and prev_c < thr:
                t = "Upgrade"
            elif closing > prev_c:
                t = "Expansion"
            else:
                t = "Recurring"
            opening = 0 if t in ("New", "Reactivation") else prev_c
            if period.first_index <= m <= period.last_index:
                rows[(ck, m)] = (t, opening, closing - opening, closing)
            prev_m, prev_c = m, closing
    return rows


event_st = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 59), st.integers(1, 60)),
    min_size=1, max_size=25)


@settings(max_examples=12, deadline=None)
@given(event_st)
def test_segments_match_brute_force(spark, evs):
    period = Period(datetime.date(2021, 1, 1), datetime.date(2023, 12, 1), 2023)
    events = []
    for i, (ck, month_off, mrr) in enumerate(evs):
        y, mth = divmod(2019 * 12 + month_off, 12)
        events.append((ck, datetime.datetime(y, mth + 1, 3), i, mrr * 1000, "r"))
    df = spark.createDataFrame(events, EVENT_SCHEMA)
    thr = 30000
    seg = lifecycle_segments(contract_months(df, period), period, thr)
    rev = expand_panel(seg, period).collect()
    got = {(int(r.customer_id[1:]), r.revenue_month.year * 12 + r.revenue_month.month - 1):
           (r.revenue_type, r.opening_mrr_inr, r.movement_mrr_inr, r.closing_mrr_inr) for r in rev}
    assert got == brute_force(events, period, thr)


def test_churn_rules(spark):
    """Lapsed and never reactivated -> churn on the 15th of the first uncovered
    month; lapsed after a reactivation -> no churn row (a pause)."""
    period = Period(datetime.date(2021, 1, 1), datetime.date(2023, 12, 1), 2023)
    ev = [
        (1, datetime.datetime(2021, 3, 5), 1, 10000, "A"),   # lapses 2022-03 -> churn
        (2, datetime.datetime(2020, 1, 5), 2, 10000, "B"),   # covered 2020-01..2020-12
        (2, datetime.datetime(2021, 6, 5), 3, 12000, "C"),   # reactivates, lapses 2022-06
        (3, datetime.datetime(2023, 6, 5), 4, 40000, "D"),   # active at end
        (4, datetime.datetime(2020, 2, 5), 5, 9000, "E"),    # lapses 2021-02, before... inside window
        (4, datetime.datetime(2020, 2, 9), 6, 9500, "F"),    # later order same month wins reason
    ]
    df = spark.createDataFrame(ev, EVENT_SCHEMA)
    seg = lifecycle_segments(contract_months(df, period), period, 30000)
    ch = {r.customer_id: r for r in churn_facts(customer_lifecycle(seg, period, 30000), df).collect()}
    assert set(ch) == {"C1", "C4"}
    assert ch["C1"].churn_date == datetime.date(2022, 3, 15)
    assert ch["C1"].tenure_months == 12 and ch["C1"].mrr_lost_inr == 10000
    assert ch["C4"].churn_reason == "F" and ch["C4"].mrr_lost_inr == 9500
    assert ch["C4"].churn_date == datetime.date(2021, 2, 15)


def test_events_after_window_ignored(spark):
    period = Period(datetime.date(2021, 1, 1), datetime.date(2021, 12, 1), 2021)
    ev = [(1, datetime.datetime(2021, 12, 31, 23, 0), 1, 1000, "A"),
          (1, datetime.datetime(2022, 1, 1), 2, 99000, "B")]
    df = spark.createDataFrame(ev, EVENT_SCHEMA)
    seg = lifecycle_segments(contract_months(df, period), period, 30000)
    rev = expand_panel(seg, period).collect()
    assert [(r.revenue_type, r.closing_mrr_inr) for r in rev] == [("New", 1000)]


def test_plan_pushes_filter_and_prunes(spark):
    m = model_from_orders(spark, SF_SMALL, order_period(spark, SF_SMALL))
    plan = m.revenue._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    # Only the columns the panel needs are read (no status, no priority here).
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    # One exchange for the (customer, month) aggregate, one for the customer window.
    assert plan.count("Exchange hashpartitioning") == 2
    assert F is not None


def test_panel_from_lifecycle_specs(spark):
    from arrlens.operators.lifecycle import panel_from_lifecycles
    from arrlens.sources.tables import products_table
    D = datetime.date
    period = Period(D(2023, 1, 1), D(2023, 12, 1), 2023)
    life = spark.createDataFrame([
        ("C1", D(2022, 10, 1), None),          # opening cohort, upgrade, pause, reactivation
        ("C2", D(2023, 3, 1), D(2023, 7, 1)),  # new, churns: last row 2023-06
        ("C3", D(2023, 9, 1), None),           # new, open pause from 2023-11
    ], "customer_id string, contract_month date, churn_month date")
    pauses = spark.createDataFrame([
        ("C1", D(2023, 5, 1), D(2023, 8, 1)),
        ("C3", D(2023, 11, 1), None),
    ], "customer_id string, pause_start date, reactivation_month date")
    changes = spark.createDataFrame([
        ("C1", D(2022, 10, 1), "P001", 100), ("C1", D(2023, 2, 1), "P002", 300),
        ("C1", D(2023, 6, 1), "P002", 350),    # inside the pause: in force at reactivation
        ("C2", D(2023, 3, 1), "P001", 50), ("C2", D(2023, 5, 1), "P001", 60),
        ("C3", D(2023, 9, 1), "P002", 500),
    ], "customer_id string, change_month date, product_id string, mrr long")
    rows = panel_from_lifecycles(life, pauses, changes, products_table(spark), period).collect()
    got = {(r.customer_id, r.revenue_month.month): (r.revenue_type, r.opening_mrr_inr,
                                                     r.closing_mrr_inr, r.product_id) for r in rows}
    assert got[("C1", 1)] == ("Recurring", 100, 100, "P001")     # history before the window
    assert got[("C1", 2)] == ("Upgrade", 100, 300, "P002")
    assert ("C1", 5) not in got and ("C1", 7) not in got
    assert got[("C1", 8)] == ("Reactivation", 0, 350, "P002")
    assert got[("C2", 3)] == ("New", 0, 50, "P001")
    assert got[("C2", 5)] == ("Expansion", 50, 60, "P001")
    assert max(m for c, m in got if c == "C2") == 6                # churn cut
    assert sorted(m for c, m in got if c == "C3") == [9, 10]       # open pause
    assert len(rows) == 12 - 3 + 4 + 2
    assert all(r.revenue_id == f"R{r.customer_id}-{r.revenue_month:%Y%m}" for r in rows)


def test_lifecycle_specs_tolerate_duplicated_inputs(spark):
    """A flood of copies of the same change / pause rows for one customer is
    collapsed before collection and gives the same panel."""
    from arrlens.operators.lifecycle import panel_from_lifecycles
    from arrlens.sources.tables import products_table
    D = datetime.date
    period = Period(D(2023, 1, 1), D(2023, 12, 1), 2023)
    life = spark.createDataFrame([("C1", D(2023, 1, 1), None)],
                                 "customer_id string, contract_month date, churn_month date")
    one_change = [("C1", D(2023, 1, 1), "P001", 100), ("C1", D(2023, 4, 1), "P001", 120)]
    one_pause = [("C1", D(2023, 6, 1), D(2023, 9, 1))]
    cs = "customer_id string, change_month date, product_id string, mrr long"
    ps = "customer_id string, pause_start date, reactivation_month date"
    prods = products_table(spark)
    base = panel_from_lifecycles(life, spark.createDataFrame(one_pause, ps),
                                 spark.createDataFrame(one_change, cs), prods, period)
    many = panel_from_lifecycles(
        life, spark.createDataFrame(one_pause * 500, ps),
        spark.createDataFrame(one_change * 500 + [("C1", D(2023, 4, 1), "P001", 110)], cs),
        prods, period)
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, many.collect()))
    assert base.count() == 12 - 3


def test_hot_customer_collapses_before_the_window(spark):
    """One customer holds half of all events, spread over every input
    partition: the (customer, month) aggregate combines map-side, the window
    sees at most one row per signing month for it, and the panel still
    equals the brute-force expansion."""
    period = Period(datetime.date(2021, 1, 1), datetime.date(2023, 12, 1), 2023)
    events = []
    for i in range(4000):
        hot = i % 2 == 0
        ck = 7 if hot else 100 + i % 50
        y, mth = divmod(2019 * 12 + (i * 7) % 60, 12)
        events.append((ck, datetime.datetime(y, mth + 1, 1 + i % 27), i, (1 + i % 45) * 1000, "r"))
    df = spark.createDataFrame(events, EVENT_SCHEMA).repartition(8)
    cm = contract_months(df, period)
    hot_months = {(e[1].year, e[1].month) for e in events if e[0] == 7}
    assert cm.where(F.col("customer_key") == 7).count() == len(hot_months)
    plan = cm._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    seg = lifecycle_segments(cm, period, 30000)
    rev = expand_panel(seg, period).collect()
    got = {(int(r.customer_id[1:]), r.revenue_month.year * 12 + r.revenue_month.month - 1):
           (r.revenue_type, r.opening_mrr_inr, r.movement_mrr_inr, r.closing_mrr_inr) for r in rev}
    assert got == brute_force(events, period, 30000)
