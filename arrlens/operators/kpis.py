"""KPI operators Q02-Q12 over the revenue panel: ``(Model, Period) -> DataFrame``.

Scale notes shared by all of them:

* Every revenue scan starts with a month-range filter, which becomes a
  pushed-down parquet filter (or a partition filter on a month-partitioned
  store).
* Aggregates run two-phase; low-cardinality keys (month, year, channel,
  segment) collapse map-side, so a hot key cannot overload one reducer.
* Month-grain results read ``month_facts`` and customer-grain ones
  ``account_facts``, which a suite builds once each from one scan; the customer
  dimension joins one row per customer, never one per customer-month.
* Global windows (``lag`` over months/years, mix share ``sum() over ()``) run
  only on already-aggregated rows: at most one row per month, year or
  dimension value.
* Distinct customers are counted exactly, by bitmaps of customer numbers where
  the model has them. ``unique_keys=True`` may be passed once the quality gate
  has proven that (revenue_month, customer_id) is unique: per-month distinct
  counts then become plain row counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import (combine_single_rows, count_when, growth_pct, pct,
                                  ratio, raw_growth, sum_when)
from ..functions.months import fiscal_year, month_key
from ..schema import MOVEMENT_TYPES, POST_SALE_TYPES, Model, Period
from ..sources.tables import retention_windows



def _between(col: Column, lo, hi) -> Column:
    return col.between(F.lit(lo), F.lit(hi))


def in_window(p: Period) -> Column:
    return _between(F.col("revenue_month"), p.start, p.end)


def in_year(p: Period) -> Column:
    return _between(F.col("revenue_month"), p.year_start, p.year_end)


def at_end(p: Period) -> Column:
    return F.col("revenue_month") == F.lit(p.year_end)


def churn_in_window(model: Model, p: Period) -> DataFrame:
    return model.churn.where(_between(F.col("churn_date"), p.start, p.end_day))


def distinct_customers(unique_keys: bool) -> Column:
    if unique_keys:
        return F.count(F.col("customer_id"))
    return F.count_distinct(F.col("customer_id"))


def _order_global() -> Window:
    # Single-partition window: only ever applied to per-month / per-year rows.
    return Window.partitionBy()


# --------------------------------------------------------------------------
# Q02 executive KPIs
# --------------------------------------------------------------------------
def executive_kpis(model: Model, p: Period, unique_keys: bool = False,
                   months: DataFrame | None = None) -> DataFrame:
    """One row: period revenue, ending base, new business, growth events,
    NRR/GRR of the year-start cohort and two-year MRR growth.

    All sums are read off the month facts (one row a month); only the retention
    cohort reads the fact, two months of it in one shuffle by customer."""
    facts = month_facts(model, unique_keys) if months is None else months
    end, yr = at_end(p), in_year(p)

    def in_the_year(kind: str) -> Column:
        return (F.sum(F.when(yr, F.col(f"moved_{kind}"))) * 12).cast("long")
    base = facts.agg(
        # SUM over no rows is null: no otherwise() here.
        F.sum(F.when(in_window(p), F.col("recognized_revenue_inr"))).cast("long").alias("total_revenue_inr"),
        F.sum(F.when(end, F.col("ending_mrr_inr"))).cast("long").alias("ending_mrr_inr"),
        sum_when(end, "active_customers").alias("_active"),
        sum_when(yr, "n_New").alias("_new"),
        (F.sum(F.when(yr & (F.col("n_New") > 0), F.col("moved_New"))) * 12).cast("long").alias("new_arr_inr"),
        in_the_year("Expansion").alias("expansion_arr_inr"),
        in_the_year("Upgrade").alias("upgrade_arr_inr"),
        in_the_year("Reactivation").alias("reactivated_arr_inr"),
        F.sum(F.when(F.col("revenue_month") == F.lit(p.two_years_back), F.col("ending_mrr_inr"))).cast("long").alias("_two_back_mrr"),
    ).withColumns({"ending_active_customers": F.coalesce("_active", F.lit(0)), "new_customers": F.coalesce("_new", F.lit(0))}).drop("_active", "_new")
    ret = retention_totals(model, p.prior_year_end, p.year_end)
    one = combine_single_rows(base, ret)
    return one.select(
        "total_revenue_inr", "ending_mrr_inr",
        (F.col("ending_mrr_inr") * 12).alias("ending_arr_inr"),
        F.col("ending_active_customers").cast("long").alias("ending_active_customers"),
        F.col("new_customers").cast("long").alias("new_customers"), "new_arr_inr", "expansion_arr_inr",
        "upgrade_arr_inr", "reactivated_arr_inr",
        pct("_retained_mrr", "_start_mrr").alias("nrr_pct"),
        pct("_gross_retained_mrr", "_start_mrr").alias("grr_pct"),
        growth_pct("ending_mrr_inr", "_two_back_mrr").alias("two_year_mrr_growth_pct"),
    )


def cohort_pivot(model: Model, start_month, end_month) -> DataFrame:
    """Per customer of the start-month cohort: starting and ending MRR
    (ending 0 when absent at the end month, T16/T17)."""
    rv = model.revenue.where(F.col("revenue_month").isin(F.lit(start_month), F.lit(end_month)))
    per = rv.groupBy("customer_id").agg(
        F.max(F.when(F.col("revenue_month") == F.lit(start_month), F.col("closing_mrr_inr"))).alias("s"),
        F.max(F.when(F.col("revenue_month") == F.lit(end_month), F.col("closing_mrr_inr"))).alias("e"))
    return per.where(F.col("s").isNotNull()).select(
        "customer_id", F.col("s").alias("start_mrr"),
        F.coalesce(F.col("e"), F.lit(0)).alias("end_mrr"))


def retention_totals(model: Model, start_month, end_month) -> DataFrame:
    c = cohort_pivot(model, start_month, end_month)
    return c.agg(
        F.sum("start_mrr").cast("long").alias("_start_mrr"),
        F.sum("end_mrr").cast("long").alias("_retained_mrr"),
        F.sum(F.least("start_mrr", "end_mrr")).cast("long").alias("_gross_retained_mrr"))


# --------------------------------------------------------------------------
# Q03 monthly revenue and growth
# --------------------------------------------------------------------------
def month_facts(model: Model, unique_keys: bool = False) -> DataFrame:
    """One row for each month of the model: sums, rows, active customers, rows
    (``n_<type>``) and movement (``moved_<type>``) of each revenue type, and rows
    with a customer (``customer_rows``) or a wrong ARR (``bad_arr``). All
    month-grain results (Q02, Q03, Q07, Q10, Q12, month coverage) and the
    uniqueness checks (D2, C2) read this, so a suite reads the revenue table
    once for them.

    Active customers are counted exactly. With customer numbers each task sets
    their bits in bitmaps by (month, 32,768 numbers) and only bitmaps are
    exchanged; without, distinct (month, customer) pairs are. Bitmaps need their
    rows sorted, so they are made beside the sums, of rows of two columns."""
    by_type = [x for t in model.domains.revenue_types for x in (
        count_when(F.col("revenue_type") == t).alias(f"n_{t}"),
        sum_when(F.col("revenue_type") == t, F.col("movement_mrr_inr")).alias(f"moved_{t}"))]
    sums = [F.count(F.lit(1)).alias("revenue_rows"),
            F.sum("recognized_revenue_inr").cast("long").alias("recognized_revenue_inr"),
            F.sum("closing_mrr_inr").cast("long").alias("ending_mrr_inr"),
            F.sum("arr_run_rate_inr").cast("long").alias("ending_arr_inr"),
            F.count("customer_id").alias("customer_rows"),
            F.count_if(F.col("arr_run_rate_inr") != F.col("closing_mrr_inr") * 12).alias("bad_arr"), *by_type]
    if unique_keys or model.numbered is None:
        return model.revenue.groupBy("revenue_month").agg(
            *sums, distinct_customers(unique_keys).cast("long").alias("active_customers"))
    rows, (bits, of_bits) = model.numbered, customer_bits(F.col("customer_no"))
    parts = rows.groupBy("revenue_month", of_bits).agg(bits)
    active = parts.groupBy(F.col("revenue_month").alias("_month")).agg(F.sum(F.bitmap_count("_bits")).alias("_active"))
    months = rows.groupBy("revenue_month").agg(*sums)
    return months.join(active, F.col("revenue_month").eqNullSafe(F.col("_month")), "left").select(
        *months.columns, F.coalesce("_active", F.lit(0)).cast("long").alias("active_customers"))


def customer_bits(number: Column) -> tuple[Column, Column]:
    """An aggregate that sets the bits of customer numbers (``_bits``; nulls set
    none), and the group of numbers whose bits stand together (``_of_bits``)."""
    return (F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"),
            F.bitmap_bucket_number(number).alias("_of_bits"))


def _months(model: Model, p: Period, unique_keys: bool, months: DataFrame | None) -> DataFrame:
    """Month facts of the window."""
    return (month_facts(model, unique_keys) if months is None else months).where(in_window(p))


def monthly_rollup(model: Model, p: Period, unique_keys: bool = False, months: DataFrame | None = None) -> DataFrame:
    return _months(model, p, unique_keys, months).select(
        "revenue_month", "recognized_revenue_inr", "ending_mrr_inr", "ending_arr_inr", "active_customers",
        F.col("n_New").alias("new_customers"), F.col("n_Reactivation").alias("reactivated_customers"),
        F.col("moved_Expansion").alias("expansion_mrr_inr"), F.col("moved_Upgrade").alias("upgrade_mrr_inr"),
        F.col("moved_Reactivation").alias("reactivated_mrr_inr"))


def monthly_revenue_growth(model: Model, p: Period, unique_keys: bool = False,
                           months: DataFrame | None = None) -> DataFrame:
    """Per month: revenue, MRR, ARR, active and new customers, movement MRR and
    YoY MRR growth (row lag of 12, T7)."""
    mon = monthly_rollup(model, p, unique_keys, months)
    w = Window.orderBy("revenue_month")
    prev = F.lag("ending_mrr_inr", 12).over(w)
    return mon.select(
        "revenue_month", "recognized_revenue_inr", "ending_mrr_inr", "ending_arr_inr",
        "active_customers", "new_customers", "expansion_mrr_inr", "upgrade_mrr_inr",
        "reactivated_mrr_inr",
        growth_pct("ending_mrr_inr", prev).alias("yoy_mrr_growth_pct"),
    ).orderBy("revenue_month")


# --------------------------------------------------------------------------
# Customer-grain rollup shared by Q04, Q09, Q11
# --------------------------------------------------------------------------
def account_facts(model: Model, p: Period) -> DataFrame:
    """One row for each (customer, product) with revenue: what the customer- and
    plan-grain results (Q04, Q05, Q09, Q11) and the checks of revenue's foreign
    keys (D3, D4, D7, C3) read, so a suite reads the revenue table once for them. ``recognized_revenue_inr`` and ``upgrade_events`` are
    of all time (T11, T12), ``window_*`` of the window."""
    yr, win, end = in_year(p), in_window(p), at_end(p)

    def moved(kind: str) -> Column:
        return sum_when(yr & (F.col("revenue_type") == kind), F.col("movement_mrr_inr") * 12)
    rows = model.revenue if model.numbered is None else model.numbered
    number = [] if model.numbered is None else [F.min("customer_no").alias("customer_no")]
    return rows.groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).alias("revenue_rows"), *number,
        count_when(F.col("revenue_type") == "Reactivation").alias("reactivations"),
        F.sum("recognized_revenue_inr").cast("long").alias("recognized_revenue_inr"),
        count_when(win).alias("window_rows"),
        F.sum(F.when(win, F.col("recognized_revenue_inr"))).cast("long").alias("window_revenue_inr"),
        F.coalesce(F.bool_or(end), F.lit(False)).alias("active_at_end"),
        sum_when(end, F.col("arr_run_rate_inr")).alias("ending_arr_inr"),
        moved("New").alias("new_arr_inr"), moved("Expansion").alias("expansion_arr_inr"),
        moved("Upgrade").alias("upgrade_arr_inr"), moved("Reactivation").alias("reactivated_arr_inr"),
        count_when(F.col("revenue_type") == "Upgrade").alias("upgrade_events"))


def customer_rollup(model: Model, p: Period, accounts: DataFrame | None = None) -> DataFrame:
    """One row per customer with revenue."""
    facts = account_facts(model, p) if accounts is None else accounts
    sums = ["recognized_revenue_inr", "ending_arr_inr", "new_arr_inr", "expansion_arr_inr", "upgrade_arr_inr",
            "reactivated_arr_inr", "upgrade_events"]
    out = facts.groupBy("customer_id").agg(*[F.sum(n).cast("long").alias(n) for n in sums])
    return out.withColumn("expansion_upgrade_arr_inr", F.col("expansion_arr_inr") + F.col("upgrade_arr_inr"))


_ZERO_DEFAULT = ["ending_arr_inr", "new_arr_inr", "expansion_arr_inr", "upgrade_arr_inr",
                 "reactivated_arr_inr", "expansion_upgrade_arr_inr", "upgrade_events"]


def customers_with_rollup(model: Model, p: Period, dims: list[str], accounts: DataFrame | None = None) -> DataFrame:
    """customers LEFT JOIN per-customer rollup. Conditional sums of customers
    without revenue become 0; recognized revenue stays null (T9)."""
    cust = model.customers.select("customer_id", *dims)
    j = cust.join(customer_rollup(model, p, accounts), "customer_id", "left")
    return j.select("customer_id", *dims, "recognized_revenue_inr",
                    *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in _ZERO_DEFAULT])


def _churned() -> Column:
    return F.col("lifecycle_status") == "Churned"


# --------------------------------------------------------------------------
# Q04 acquisition channel performance
# --------------------------------------------------------------------------
def channel_performance(model: Model, p: Period, accounts: DataFrame | None = None) -> DataFrame:
    j = customers_with_rollup(model, p, ["acquisition_channel", "first_contract_date",
                                         "lifecycle_status"], accounts)
    ending = F.col("ending_arr_inr")
    new_in_year = _between(F.col("first_contract_date"), p.year_start, p.year_end_day)
    g = j.groupBy("acquisition_channel").agg(
        F.count(F.lit(1)).alias("acquired_customers"),
        count_when(new_in_year).alias("new_customers"),
        count_when(ending > 0).alias("active_customers_at_end"),
        F.sum("recognized_revenue_inr").cast("long").alias("recognized_revenue_inr"),
        F.sum(ending).cast("long").alias("ending_arr_inr"),
        F.sum("new_arr_inr").cast("long").alias("new_arr_inr"),
        F.sum("expansion_arr_inr").cast("long").alias("expansion_arr_inr"),
        F.sum("upgrade_arr_inr").cast("long").alias("upgrade_arr_inr"),
        F.sum("reactivated_arr_inr").cast("long").alias("reactivated_arr_inr"),
        count_when(_churned()).alias("permanently_churned_customers"),
    )
    return g.select(
        "*",
        pct("permanently_churned_customers", "acquired_customers").alias("observed_logo_churn_pct"),
        ratio("ending_arr_inr", "active_customers_at_end", 0).alias("avg_arr_per_active_customer_inr"),
    ).orderBy(F.desc("ending_arr_inr"), "acquisition_channel")


# --------------------------------------------------------------------------
# Q05 plan tier x segment performance
# --------------------------------------------------------------------------
def plan_segment_performance(model: Model, p: Period, accounts: DataFrame | None = None) -> DataFrame:
    """Tier of the plan *on each revenue row* (moves on upgrade, T13)."""
    pre = (account_facts(model, p) if accounts is None else accounts).where(F.col("window_rows") > 0)
    prods = model.products.select("product_id", "plan_tier")
    j = pre.join(model.customers.select("customer_id", "company_segment"), "customer_id")
    names = ["recognized_revenue_inr", "ending_arr_inr", "new_arr_inr", "expansion_arr_inr", "upgrade_arr_inr"]
    j = j.withColumn("recognized_revenue_inr", F.col("window_revenue_inr"))
    if "customer_no" in j.columns:
        # Exchange bitmaps of the active customers, as month_facts does; the plans'
        # few rows meet products, and plans of a tier merge their bitmaps.
        bits, of_bits = customer_bits(F.when(F.col("active_at_end"), F.col("customer_no")))
        by_plan = j.groupBy("product_id", "company_segment", of_bits).agg(*[F.sum(n).alias(n) for n in names], bits)
        parts = by_plan.join(prods, "product_id").groupBy("plan_tier", "company_segment", "_of_bits").agg(
            *[F.sum(n).alias(n) for n in names], F.bitmap_or_agg("_bits").alias("_bits"))
        active = F.sum(F.bitmap_count("_bits"))
    else:
        parts = j.join(prods, "product_id")
        active = F.count_distinct(F.when(F.col("active_at_end"), F.col("customer_id")))
    g = parts.groupBy("plan_tier", "company_segment").agg(
        active.cast("long").alias("active_customers_at_end"), *[F.sum(n).cast("long").alias(n) for n in names])
    total = F.sum("ending_arr_inr").over(_order_global())
    return g.select("*", pct("ending_arr_inr", total).alias("ending_arr_mix_pct")) \
        .orderBy(F.desc("ending_arr_inr"), "plan_tier", "company_segment")


# --------------------------------------------------------------------------
# Q06 annual retention
# --------------------------------------------------------------------------
def annual_retention(model: Model, p: Period, windows=None) -> DataFrame:
    """NRR, GRR and logo retention per fiscal year of start-month cohorts.

    Revenue is read only at the boundary months; each row meets the (year,
    month, role) table, which has two rows per year and is broadcast, then
    one groupBy (year, customer) pivots start/end MRR."""
    spark = model.revenue.sparkSession
    wins = retention_windows(spark, windows if windows is not None else p.retention_windows())
    roles = (wins.select("year", F.col("start_month").alias("month"), F.lit("s").alias("role"))
             .unionByName(wins.select("year", F.col("end_month").alias("month"),
                                      F.lit("e").alias("role"))))
    bounds = sorted({d for w in (windows if windows is not None else p.retention_windows())
                     for d in (w[1], w[2])})
    rv = model.revenue.where(F.col("revenue_month").isin(*[F.lit(d) for d in bounds])) \
        .select("customer_id", "revenue_month", "closing_mrr_inr")
    # roles: two rows per fiscal year of the window, bounded by construction.
    j = rv.join(F.broadcast(roles), rv.revenue_month == roles.month)
    per = j.groupBy("year", "customer_id").agg(
        F.max(F.when(F.col("role") == "s", F.col("closing_mrr_inr"))).alias("s"),
        F.max(F.when(F.col("role") == "e", F.col("closing_mrr_inr"))).alias("e"),
    ).where(F.col("s").isNotNull())
    e0 = F.coalesce(F.col("e"), F.lit(0))
    g = per.groupBy("year").agg(
        F.count(F.lit(1)).alias("starting_customers"),
        count_when(e0 > 0).alias("retained_customers"),
        F.sum("s").cast("long").alias("starting_mrr_inr"),
        F.sum(e0).cast("long").alias("ending_mrr_same_cohort_inr"),
        F.sum(F.least(F.col("s"), e0)).cast("long").alias("_gross"),
    )
    return g.select(
        F.col("year").cast("long").alias("year"), "starting_customers", "retained_customers",
        "starting_mrr_inr", "ending_mrr_same_cohort_inr",
        pct("ending_mrr_same_cohort_inr", "starting_mrr_inr").alias("nrr_pct"),
        pct("_gross", "starting_mrr_inr").alias("grr_pct"),
        pct("retained_customers", "starting_customers").alias("logo_retention_pct"),
    ).orderBy("year")


# --------------------------------------------------------------------------
# Q07 growth event bridge
# --------------------------------------------------------------------------
def growth_event_bridge(model: Model, p: Period, months: DataFrame | None = None) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(t).alias("revenue_type"), F.col(f"n_{t}").alias("n"), F.col(f"moved_{t}").alias("moved"))
                      for t in MOVEMENT_TYPES])
    rows = _months(model, p, True, months).select("revenue_month", F.inline(kinds)).where("n > 0")
    g = rows.groupBy(fiscal_year("revenue_month", p.fy_end_month).alias("year"), "revenue_type").agg(
        F.sum("n").cast("long").alias("event_count"),
        F.sum("moved").cast("long").alias("added_mrr_inr"),
        (F.sum("moved") * 12).cast("long").alias("added_arr_inr"),
    )
    order = F.array_position(F.array(*[F.lit(t) for t in MOVEMENT_TYPES]), F.col("revenue_type"))
    return g.orderBy("year", order)


# --------------------------------------------------------------------------
# Q08 churn reasons
# --------------------------------------------------------------------------
def churn_reasons(model: Model, p: Period) -> DataFrame:
    g = churn_in_window(model, p).groupBy("churn_reason").agg(
        F.count(F.lit(1)).alias("churned_customers"),
        F.sum("mrr_lost_inr").cast("long").alias("mrr_lost_inr"),
        (F.sum("mrr_lost_inr") * 12).cast("long").alias("arr_lost_inr"),
        F.round(F.avg("tenure_months"), 1).alias("avg_tenure_months"),
    )
    total = F.sum("mrr_lost_inr").over(_order_global())
    return g.select("*", pct("mrr_lost_inr", total).alias("lost_arr_mix_pct")) \
        .orderBy(F.desc("arr_lost_inr"), "churn_reason")


# --------------------------------------------------------------------------
# Q09 sales owner performance
# --------------------------------------------------------------------------
def sales_owner_performance(model: Model, p: Period, accounts: DataFrame | None = None) -> DataFrame:
    j = customers_with_rollup(model, p, ["sales_owner", "lifecycle_status"], accounts)
    ending = F.col("ending_arr_inr")
    g = j.groupBy("sales_owner").agg(
        F.count(F.lit(1)).alias("managed_customers"),
        count_when(ending > 0).alias("active_customers_at_end"),
        F.sum(ending).cast("long").alias("ending_arr_inr"),
        F.sum("new_arr_inr").cast("long").alias("new_arr_inr"),
        F.sum("expansion_upgrade_arr_inr").cast("long").alias("expansion_upgrade_arr_inr"),
        F.sum("upgrade_events").cast("long").alias("upgrade_events"),
        count_when(_churned()).alias("_churned"),
    )
    return g.select(
        "sales_owner", "managed_customers", "active_customers_at_end", "ending_arr_inr",
        "new_arr_inr", "expansion_upgrade_arr_inr", "upgrade_events",
        pct("_churned", "managed_customers").alias("observed_logo_churn_pct"),
    ).orderBy(F.desc("ending_arr_inr"), "sales_owner")


# --------------------------------------------------------------------------
# Q10 monthly customer flow
# --------------------------------------------------------------------------
def customer_flow(model: Model, p: Period, unique_keys: bool = False, months: DataFrame | None = None) -> DataFrame:
    mon = monthly_rollup(model, p, unique_keys, months).select(
        "revenue_month", "active_customers", "ending_arr_inr", "new_customers",
        "reactivated_customers")
    chm = churn_in_window(model, p).groupBy(month_key("churn_date").alias("revenue_month")).agg(
        F.count(F.lit(1)).alias("churned"),
        (F.sum("mrr_lost_inr") * 12).cast("long").alias("arr_lost"))
    comb = mon.join(chm, "revenue_month", "left").select(
        "revenue_month", "active_customers", "ending_arr_inr", "new_customers",
        "reactivated_customers",
        F.coalesce("churned", F.lit(0)).cast("long").alias("permanently_churned_customers"),
        F.coalesce("arr_lost", F.lit(0)).cast("long").alias("permanent_churn_arr_lost_inr"))
    w = Window.orderBy("revenue_month")
    prev_active = F.lag("active_customers", 1).over(w)
    py_arr = F.lag("ending_arr_inr", 12).over(w)
    py_active = F.lag("active_customers", 12).over(w)
    return comb.select(
        "revenue_month", "active_customers", "new_customers", "reactivated_customers",
        "permanently_churned_customers",
        (F.col("new_customers") - F.col("permanently_churned_customers"))
        .alias("net_new_minus_permanent_churn"),
        (F.col("active_customers") - prev_active).alias("net_active_customer_change"),
        "ending_arr_inr",
        ratio("ending_arr_inr", "active_customers", 0).alias("avg_arr_per_active_customer_inr"),
        "permanent_churn_arr_lost_inr",
        growth_pct("ending_arr_inr", py_arr).alias("yoy_arr_growth_pct"),
        growth_pct("active_customers", py_active).alias("yoy_active_customer_growth_pct"),
    ).orderBy("revenue_month")


# --------------------------------------------------------------------------
# Q11 segment churn and retention by starting plan
# --------------------------------------------------------------------------
def segment_churn_retention(model: Model, p: Period, accounts: DataFrame | None = None) -> DataFrame:
    """Tier of the customer's *initial* plan (fixed, T13)."""
    prods = model.products.select(F.col("product_id").alias("initial_product_id"),
                                  F.col("plan_tier").alias("starting_plan_tier"))
    cust = model.customers.select("customer_id", "company_segment", "initial_product_id",
                                  "lifecycle_status")
    ending_arr = customer_rollup(model, p, accounts).select("customer_id", "ending_arr_inr")
    # The joins by customer come first: where the tables lie by customer, they need no exchange.
    j = (cust.join(model.churn.select("customer_id", "mrr_lost_inr"), "customer_id", "left")
         .join(ending_arr, "customer_id", "left").join(prods, "initial_product_id"))
    ending = F.coalesce(F.col("ending_arr_inr"), F.lit(0))
    lost = F.coalesce(F.col("mrr_lost_inr") * 12, F.lit(0))
    g = j.groupBy("company_segment", "starting_plan_tier").agg(
        F.count(F.lit(1)).alias("acquired_customers"),
        count_when(_churned()).alias("permanently_churned_customers"),
        count_when(ending > 0).alias("active_customers_at_end"),
        F.sum(ending).cast("long").alias("ending_arr_inr"),
        F.sum(lost).cast("long").alias("permanent_churn_arr_lost_inr"),
    )
    return g.select(
        "company_segment", "starting_plan_tier", "acquired_customers",
        "permanently_churned_customers",
        pct("permanently_churned_customers", "acquired_customers").alias("observed_logo_churn_pct"),
        "active_customers_at_end", "ending_arr_inr", "permanent_churn_arr_lost_inr",
        ratio("ending_arr_inr", "active_customers_at_end", 0).alias("avg_arr_per_active_customer_inr"),
    ).orderBy(F.desc("observed_logo_churn_pct"), F.desc("ending_arr_inr"),
              "company_segment", "starting_plan_tier")


# --------------------------------------------------------------------------
# Q12 growth quality
# --------------------------------------------------------------------------
def growth_quality(model: Model, p: Period, unique_keys: bool = False, months: DataFrame | None = None) -> DataFrame:
    fy = p.fy_end_month
    mon = _months(model, p, unique_keys, months).withColumn("year", fiscal_year("revenue_month", fy))
    ye = mon.where(F.month("revenue_month") == fy).select(
        "year", "ending_arr_inr", "active_customers",
        ratio("ending_arr_inr", "active_customers", 0).alias("avg_arr_per_active_customer_inr"))
    post_sale = reduce(lambda x, y: x + y, [F.col(f"moved_{t}") for t in POST_SALE_TYPES])
    an = mon.groupBy("year").agg(F.sum("n_New").cast("long").alias("new_customers"),
                                 (F.sum(post_sale) * 12).cast("long").alias("post_sale_added_arr_inr"))
    ac = churn_in_window(model, p).groupBy(fiscal_year("churn_date", fy).alias("year")).agg(
        F.count(F.lit(1)).alias("churned"),
        (F.sum("mrr_lost_inr") * 12).cast("long").alias("arr_lost"))
    j = ye.join(an, "year").join(ac, "year", "left")
    churned = F.coalesce("churned", F.lit(0)).cast("long")
    w = Window.orderBy("year")
    prev_arr = F.lag("ending_arr_inr").over(w)
    prev_act = F.lag("active_customers").over(w)
    prev_avg = F.lag("avg_arr_per_active_customer_inr").over(w)
    base = j.select(
        "year", "ending_arr_inr", "active_customers", "avg_arr_per_active_customer_inr",
        "new_customers", churned.alias("permanently_churned_customers"),
        (F.col("new_customers") - churned).alias("net_new_minus_permanent_churn"),
        "post_sale_added_arr_inr",
        F.coalesce("arr_lost", F.lit(0)).cast("long").alias("permanent_churn_arr_lost_inr"),
        prev_arr.alias("_pa"), prev_act.alias("_pc"), prev_avg.alias("_pv"))
    return base.select(
        "year", "ending_arr_inr", "active_customers", "avg_arr_per_active_customer_inr",
        "new_customers", "permanently_churned_customers", "net_new_minus_permanent_churn",
        "post_sale_added_arr_inr", "permanent_churn_arr_lost_inr",
        growth_pct("ending_arr_inr", "_pa").alias("yoy_arr_growth_pct"),
        growth_pct("active_customers", "_pc").alias("yoy_active_customer_growth_pct"),
        # Growth of averages that were already rounded.
        growth_pct("avg_arr_per_active_customer_inr", "_pv").alias("yoy_avg_arr_per_customer_growth_pct"),
        # Difference of unrounded growths, rounded once.
        F.round(raw_growth("ending_arr_inr", "_pa") - raw_growth("active_customers", "_pc"), 1)
        .alias("arr_growth_minus_customer_growth_pp"),
    ).orderBy("year")


KPI_QUERIES = {
    "executive_kpis": executive_kpis,
    "monthly_revenue_growth": monthly_revenue_growth,
    "channel_performance": channel_performance,
    "plan_segment_performance": plan_segment_performance,
    "annual_retention": annual_retention,
    "growth_event_bridge": growth_event_bridge,
    "churn_reasons": churn_reasons,
    "sales_owner_performance": sales_owner_performance,
    "customer_flow": customer_flow,
    "segment_churn_retention": segment_churn_retention,
    "growth_quality": growth_quality,
}
