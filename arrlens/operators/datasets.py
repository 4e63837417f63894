"""Report datasets (R1-R10): shaped, bounded tables for a dashboard.

Money is shown in crore (10^7 INR) with exact decimal half-up rounding;
percentages become fractions; nulls stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import rate, scaled
from ..schema import GROWTH_RATE_SERIES, LOGO_FLOW_SERIES, Period


def rpt_kpis(headline: DataFrame) -> DataFrame:
    """KPI cards."""
    return headline.select(
        scaled("ending_arr_inr", dp=1).alias("ending_arr_crore"),
        "ending_active_customers",
        rate("nrr_pct").alias("nrr_rate"),
        rate("grr_pct").alias("grr_rate"),
        rate("two_year_mrr_growth_pct").alias("two_year_mrr_growth_rate"),
        rate("arr_growth_pct").alias("arr_growth_rate"),
        rate("arr_growth_prior_year_pct").alias("arr_growth_prior_year_rate"),
        rate("active_customer_growth_pct").alias("active_customer_growth_rate"),
        rate("highest_segment_observed_logo_churn_pct").alias("highest_segment_churn_rate"),
    )


def rpt_monthly(monthly: DataFrame) -> DataFrame:
    """R2: monthly ARR/MRR trend."""
    return monthly.select(
        "revenue_month",
        scaled("ending_arr_inr").alias("ending_arr_crore"),
        scaled("ending_mrr_inr").alias("ending_mrr_crore"),
        "active_customers", "new_customers",
        rate("yoy_mrr_growth_pct").alias("yoy_mrr_growth_rate"),
    ).orderBy("revenue_month")


def rpt_channels(channels: DataFrame) -> DataFrame:
    """Channels ranked by ending ARR (window over a handful of rows)."""
    w = Window.orderBy(F.desc("ending_arr_inr"), "acquisition_channel")
    return channels.select(
        F.row_number().over(w).cast("long").alias("rank"),
        "acquisition_channel",
        scaled("ending_arr_inr").alias("ending_arr_crore"),
        scaled("new_arr_inr").alias("new_arr_crore"),
        "active_customers_at_end",
        rate("observed_logo_churn_pct").alias("observed_logo_churn_rate"),
        scaled("avg_arr_per_active_customer_inr", dp=3).alias("avg_arr_per_active_customer_crore"),
    ).orderBy("rank")


def rpt_growth_events(bridge: DataFrame, p: Period) -> DataFrame:
    """Growth events of the report year."""
    return bridge.where(F.col("year") == p.report_year).select(
        "revenue_type", "event_count",
        scaled("added_arr_inr").alias("added_arr_crore"),
        scaled("added_mrr_inr").alias("added_mrr_crore"),
    )


def rpt_churn_reasons(reasons: DataFrame) -> DataFrame:
    """R5."""
    return reasons.select(
        "churn_reason", "churned_customers",
        scaled("arr_lost_inr").alias("arr_lost_crore"),
        rate("lost_arr_mix_pct").alias("lost_arr_mix_rate"),
        "avg_tenure_months",
    )


def rpt_logo_flow(flow: DataFrame) -> DataFrame:
    """Wide monthly flow to long (two series per month)."""
    pairs = ", ".join(f"'{label}', `{col}`" for label, col in LOGO_FLOW_SERIES)
    return flow.selectExpr(
        "revenue_month",
        f"stack({len(LOGO_FLOW_SERIES)}, {pairs}) AS (flow_type, customer_count)",
        "active_customers", "net_active_customer_change",
    ).orderBy("revenue_month", "flow_type")


def yoy_series(flow: DataFrame) -> DataFrame:
    """Months that have a year-over-year value."""
    return flow.where(F.col("yoy_arr_growth_pct").isNotNull())


def rpt_growth_rates(flow: DataFrame) -> DataFrame:
    """ARR vs active-customer YoY growth, long format."""
    pairs = ", ".join(f"'{label}', `{col}` / 100.0D" for label, col in GROWTH_RATE_SERIES)
    return yoy_series(flow).selectExpr(
        "revenue_month",
        f"stack({len(GROWTH_RATE_SERIES)}, {pairs}) AS (growth_series, yoy_growth_rate)",
    ).orderBy("revenue_month", "growth_series")


def rpt_segment_churn(segments: DataFrame) -> DataFrame:
    """R8."""
    return segments.select(
        "company_segment", "starting_plan_tier", "acquired_customers",
        "permanently_churned_customers",
        rate("observed_logo_churn_pct").alias("observed_logo_churn_rate"),
        "active_customers_at_end",
        scaled("ending_arr_inr").alias("ending_arr_crore"),
        scaled("permanent_churn_arr_lost_inr").alias("permanent_churn_arr_lost_crore"),
        scaled("avg_arr_per_active_customer_inr", dp=3).alias("avg_arr_per_active_customer_crore"),
    )


def rpt_growth_quality(growth: DataFrame) -> DataFrame:
    """R9."""
    return growth.select(
        "year",
        scaled("ending_arr_inr").alias("ending_arr_crore"),
        "active_customers",
        scaled("avg_arr_per_active_customer_inr", dp=3).alias("avg_arr_per_active_customer_crore"),
        "new_customers", "permanently_churned_customers", "net_new_minus_permanent_churn",
        scaled("post_sale_added_arr_inr").alias("post_sale_added_arr_crore"),
        rate("yoy_arr_growth_pct").alias("yoy_arr_growth_rate"),
        rate("yoy_active_customer_growth_pct").alias("yoy_active_customer_growth_rate"),
        rate("yoy_avg_arr_per_customer_growth_pct").alias("yoy_avg_arr_per_customer_growth_rate"),
    ).orderBy("year")
