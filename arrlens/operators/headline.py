"""Headline selectors (H1-H8): one row of 27 fields from the KPI results.

Each selector is an aggregate over a small result DataFrame (argmin/argmax with
explicit tie-breaks, filters by year instead of row position); the one-row
aggregates are folded into a single row without cross joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import combine_single_rows
from ..schema import Period


def _first_by(value, *order):
    """Value of the row that sorts first on ``order`` (ascending)."""
    return F.min_by(value, F.struct(*order))


def headline_metrics(kpis: DataFrame, channels: DataFrame, retention: DataFrame,
                     reasons: DataFrame, segments: DataFrame, growth: DataFrame,
                     p: Period) -> DataFrame:
    arr = F.col("ending_arr_inr")
    churn_pct = F.col("observed_logo_churn_pct")
    ch = channels.agg(
        # Channel table order is ending ARR desc; ties broken by name.
        _first_by("acquisition_channel", -arr, "acquisition_channel").alias("top_channel_by_ending_arr"),
        F.max(arr).alias("top_channel_ending_arr_inr"),
        # First channel (in that order) with the lowest / highest churn pct.
        _first_by("acquisition_channel", churn_pct, -arr, "acquisition_channel").alias("lowest_churn_channel"),
        _first_by("acquisition_channel", -churn_pct, -arr, "acquisition_channel").alias("highest_churn_channel"),
    )
    ret = retention.agg(
        F.max(F.when(F.col("year") == p.report_year - 1, F.col("nrr_pct"))).alias("nrr_prior_year_pct"))
    rs = reasons.agg(
        _first_by("churn_reason", -F.col("arr_lost_inr"), "churn_reason").alias("top_churn_reason"),
        F.max("arr_lost_inr").alias("top_churn_reason_arr_lost_inr"),
    )
    top_seg = _first_by(F.struct("company_segment", "starting_plan_tier", "observed_logo_churn_pct"),
                        -churn_pct, -arr, "company_segment", "starting_plan_tier")
    sg = segments.agg(top_seg.alias("_s")).select(
        F.col("_s.company_segment").alias("highest_churn_segment"),
        F.col("_s.starting_plan_tier").alias("highest_churn_segment_starting_plan"),
        F.col("_s.observed_logo_churn_pct").alias("highest_segment_observed_logo_churn_pct"))
    yr = F.col("year")
    gq = growth.agg(
        F.max(F.when(yr == p.report_year - 1, F.col("yoy_arr_growth_pct"))).alias("arr_growth_prior_year_pct"),
        F.max(F.when(yr == p.report_year, F.col("yoy_arr_growth_pct"))).alias("arr_growth_pct"),
        F.max(F.when(yr == p.report_year, F.col("yoy_active_customer_growth_pct")))
        .alias("active_customer_growth_pct"),
        F.max(F.when(yr == p.report_year, F.col("yoy_avg_arr_per_customer_growth_pct")))
        .alias("avg_arr_per_customer_growth_pct"),
        F.max(F.when(yr == p.report_year, F.col("permanently_churned_customers")))
        .alias("permanently_churned_customers"),
    )
    return combine_single_rows(kpis, ch, ret, rs, sg, gq)
