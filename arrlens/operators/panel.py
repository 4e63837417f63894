"""Subscription panel builders (P1-P12): contract activity in, revenue panel out.

Input is a DataFrame of contract events, one row per signed contract:
``customer_key, event_time, event_key, mrr, reason``. Each contract keeps the
customer active for ``term_months`` calendar months from its signing month.
Monthly recurring revenue ratchets: the closing MRR of a month is the largest
contract MRR signed up to that month, so movements are never negative.

Plan, at any scale:

1. ``contract_months``: one row per (customer, signing month). Two-phase
   aggregation, so a customer holding a third of all events is collapsed
   map-side before the shuffle and ends up as at most one row per month.
2. ``lifecycle_segments``: one window partitioned by customer over those rows
   (bounded by the number of calendar months in the history, whatever the
   event volume). For contract month i the active months are
   ``[ym_i, min(ym_i + term - 1, ym_{i+1} - 1)]``: the latest contract signed
   before a month decides whether it is covered. The movement type of the
   segment's first month comes from lag/lead on the same window; all later
   months of a segment are Recurring.
3. ``expand_panel``: a narrow explode of each segment into months, clipped to
   the model's months. No 12x fan-out, no DISTINCT, no second shuffle.
4. ``customer_lifecycle``: groupBy(customer) on the window output, which is
   already hash-partitioned by customer, so it adds no exchange.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.months import month_from_index, month_index
from ..schema import CHURN_DAY_OF_MONTH, Period, add_months

DEFAULT_TERM_MONTHS = 12
ENTERPRISE = "Enterprise"
PROFESSIONAL = "Professional"
TIER_PRODUCT = {PROFESSIONAL: "P001", ENTERPRISE: "P002"}


def customer_id_col(key_col: str = "customer_key"):
    """Natural customer id ``C<key>`` (P11: no global row_number)."""
    return F.concat(F.lit("C"), F.col(key_col).cast("string"))


def tier_of(mrr_col, threshold: int):
    return F.when(mrr_col >= F.lit(threshold), F.lit(ENTERPRISE)).otherwise(F.lit(PROFESSIONAL))


def product_of(tier_col):
    return (F.when(tier_col == ENTERPRISE, F.lit(TIER_PRODUCT[ENTERPRISE]))
            .when(tier_col == PROFESSIONAL, F.lit(TIER_PRODUCT[PROFESSIONAL])))


def contract_months(events: DataFrame, period: Period) -> DataFrame:
    """Per (customer, signing month): largest contract MRR and time of the
    latest event. Events after the model's last month are ignored; the cut-off
    is a pushed-down scan filter. Both buffers are fixed-width, so both phases
    are hash aggregates; the reason of a churn is fetched in ``churn_facts``."""
    after_end = add_months(period.history_end, 1)
    cutoff = F.lit(datetime(after_end.year, after_end.month, 1)).cast("timestamp_ntz")
    return (events
            .where(F.col("event_time") < cutoff)
            .groupBy("customer_key", month_index("event_time").alias("ym"))
            .agg(F.max("mrr").alias("mrr"),
                 F.max("event_time").alias("last_time")))


def lifecycle_segments(cm: DataFrame, period: Period, tier_threshold: int,
                       term_months: int = DEFAULT_TERM_MONTHS, first_number: int = 0) -> DataFrame:
    """Classify each contract month and give the covered segment it opens.
    Customers are numbered from ``first_number`` on (``customer_no``)."""
    w = Window.partitionBy("customer_key").orderBy("ym")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    seg = cm.select(
        "customer_key", "ym", "mrr", "last_time",
        F.lag("ym").over(w).alias("prev_ym"),
        F.lead("ym").over(w).alias("next_ym"),
        F.max("mrr").over(running).alias("closing"),
        F.max("mrr").over(before).alias("prev_closing"),
    )
    tier = tier_of(F.col("closing"), tier_threshold)
    prev_tier = tier_of(F.col("prev_closing"), tier_threshold)
    after_gap = (F.col("ym") - F.col("prev_ym")) > term_months
    # Precedence: New > Reactivation > Upgrade > Expansion > Recurring.
    first_type = (F.when(F.col("prev_ym").isNull(), F.lit("New"))
                  .when(after_gap, F.lit("Reactivation"))
                  .when((tier == ENTERPRISE) & (prev_tier == PROFESSIONAL), F.lit("Upgrade"))
                  .when(F.col("closing") > F.col("prev_closing"), F.lit("Expansion"))
                  .otherwise(F.lit("Recurring")))
    seg_end = F.least(F.col("ym") + (term_months - 1), F.col("next_ym") - 1,
                      F.lit(period.last_index).cast("long"))
    # A customer's number is that of its first row in the window's order: no
    # exchange or sort beside the window's own.
    rows = seg.select("*", F.monotonically_increasing_id().alias("_row"))
    return rows.select(
        *seg.columns,
        (F.min("_row").over(Window.partitionBy("customer_key")) + F.lit(first_number)).alias("customer_no"),
        tier.alias("tier"),
        F.coalesce(after_gap, F.lit(False)).alias("after_gap"),
        first_type.alias("first_type"),
        seg_end.alias("seg_end"),
    )


def panel_months(segments: DataFrame, period: Period) -> DataFrame:
    """What a customer-month revenue row is made from, less than half as wide:
    for sorts and exchanges, after which ``panel_rows`` makes the rows."""
    lo = F.greatest(F.col("ym"), F.lit(period.first_index).cast("long"))
    months = (segments
              .where(F.col("seg_end") >= lo)
              .select("*", F.explode(F.sequence(lo, F.col("seg_end"))).alias("m")))
    first = F.col("m") == F.col("ym")
    rtype = F.when(first, F.col("first_type")).otherwise(F.lit("Recurring"))
    opening = (F.when(first & F.col("first_type").isin("New", "Reactivation"), F.lit(0).cast("long"))
               .when(first, F.col("prev_closing"))
               .otherwise(F.col("closing")))
    return months.select(month_from_index(F.col("m")).alias("revenue_month"), "customer_key", "customer_no",
                         (F.col("tier") == ENTERPRISE).alias("enterprise"), rtype.alias("revenue_type"),
                         opening.cast("long").alias("opening"), F.col("closing").cast("long").alias("closing"))


def panel_rows(months: DataFrame, numbered: bool = False) -> DataFrame:
    """The revenue rows of ``panel_months``; a narrow projection."""
    cid = customer_id_col()
    return months.select(
        F.concat(F.lit("R"), cid, F.lit("-"), F.date_format("revenue_month", "yyyyMM")).alias("revenue_id"),
        "revenue_month",
        cid.alias("customer_id"),
        product_of(F.when(F.col("enterprise"), F.lit(ENTERPRISE)).when(~F.col("enterprise"), F.lit(PROFESSIONAL))).alias("product_id"),
        "revenue_type",
        F.col("opening").alias("opening_mrr_inr"),
        (F.col("closing") - F.col("opening")).alias("movement_mrr_inr"),
        F.col("closing").alias("closing_mrr_inr"),
        F.col("closing").alias("recognized_revenue_inr"),
        (F.col("closing") * 12).alias("arr_run_rate_inr"),
        *["customer_no"] * numbered,
    )


def expand_panel(segments: DataFrame, period: Period, numbered: bool = False) -> DataFrame:
    """Customer-month revenue rows of the model's months (P3-P8, P11); with the
    customer's number if wanted."""
    return panel_rows(panel_months(segments, period), numbered)


def customer_lifecycle(segments: DataFrame, period: Period, tier_threshold: int,
                       term_months: int = DEFAULT_TERM_MONTHS) -> DataFrame:
    """One row per customer: contract month, plans, lapse, reactivation, churn
    (P9, P10). Permanent churn = lapsed before the last month and never
    reactivated; the history ends with the model's last month."""
    agg = segments.groupBy("customer_key").agg(
        F.min("ym").alias("first_ym"),
        F.max("ym").alias("last_ym"),
        F.min("closing").alias("first_closing"),
        F.max("closing").alias("last_closing"),
        F.max(F.col("after_gap").cast("int")).alias("reactivations"),
        F.max("last_time").alias("last_time"),
    )
    last_active = F.col("last_ym") + (term_months - 1)
    churned = (last_active < F.lit(period.last_index)) & (F.col("reactivations") == 0)
    return agg.select(
        "*",
        # Closing MRR never falls, so its ends are the first and the last plan.
        tier_of(F.col("first_closing"), tier_threshold).alias("initial_tier"),
        tier_of(F.col("last_closing"), tier_threshold).alias("current_tier"),
        churned.alias("churned"),
        (F.col("last_ym") + term_months).alias("churn_ym"),
    )


def churn_facts(lifecycle: DataFrame, events: DataFrame) -> DataFrame:
    """Churn table (P9): date on the 15th of the first month without
    coverage, last plan, MRR lost and tenure in months, and the reason of the
    customer's latest event (by time, then key), read for churned customers only."""
    ch = lifecycle.where(F.col("churned"))
    last = ch.select("customer_key", F.col("last_time").alias("event_time"))
    reasons = (events.join(last, ["customer_key", "event_time"], "left_semi").groupBy("customer_key")
               .agg(F.max_by("reason", "event_key").alias("last_reason")))
    ch = ch.join(reasons, "customer_key", "left")
    cm = F.col("churn_ym")
    churn_date = F.make_date((cm / 12).cast("long").cast("int"), (cm % 12 + 1).cast("int"),
                             F.lit(CHURN_DAY_OF_MONTH))
    cid = customer_id_col()
    return ch.select(
        F.concat(F.lit("CH"), F.col("customer_key").cast("string")).alias("churn_id"),
        cid.alias("customer_id"),
        product_of(F.col("current_tier")).alias("product_id"),
        churn_date.alias("churn_date"),
        F.col("last_reason").alias("churn_reason"),
        F.col("last_closing").cast("long").alias("mrr_lost_inr"),
        (F.col("churn_ym") - F.col("first_ym")).cast("long").alias("tenure_months"),
    )


def customer_status(lifecycle: DataFrame) -> DataFrame:
    """Status and plans as of the model's last month (P10), keyed by customer_key."""
    return lifecycle.select(
        "customer_key",
        month_from_index(F.col("first_ym")).alias("first_contract_date"),
        product_of(F.col("initial_tier")).alias("initial_product_id"),
        product_of(F.col("current_tier")).alias("current_product_id"),
        F.when(F.col("churned"), F.lit("Churned")).otherwise(F.lit("Active")).alias("lifecycle_status"),
    )
