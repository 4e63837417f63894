"""Derive the four-table subscription model from order-style tables.

Each order is read as a 12-month contract signed in its order month, billed
monthly at ``floor(o_totalprice / 12)``. Dimensions: acquisition channel =
region name, sales owner = nation name, company segment = market segment,
churn reason = priority of the customer's last order (by date, then key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_from_index
from ..operators.panel import (DEFAULT_TERM_MONTHS, churn_facts, contract_months,
                               customer_id_col, customer_lifecycle, customer_status,
                               expand_panel, lifecycle_segments, panel_months, product_of)
from ..schema import Domains, Model, Period
from ..session import shared_dir
from .tables import products_table

# Fixed values for the order-derived model.
ENTERPRISE_MRR_THRESHOLD = 30000
ORDER_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ORDER_DOMAINS = Domains(segments=ORDER_SEGMENTS)
UNCLASSIFIED_INDUSTRY = "Unclassified"
# Fixed values of the defect rules for the dirty quality check (by value, not key).
DEFECT_DUPLICATE_SEGMENT = "BUILDING"
DEFECT_FORBIDDEN_FROM_SEGMENT = "HOUSEHOLD"
DEFECT_STATUS_FLIP_SEGMENT = "AUTOMOBILE"
DEFECT_ORPHAN_CHURN_REASON = "5-LOW"

def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_events(orders: DataFrame) -> DataFrame:
    """Orders as contract events (only the five columns the panel needs, so
    the parquet scan reads just those)."""
    return orders.select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_time"),
        F.col("o_orderkey").alias("event_key"),
        F.floor(F.col("o_totalprice") / F.lit(12)).cast("long").alias("mrr"),
        F.col("o_orderpriority").alias("reason"),
    )


def order_period(spark: SparkSession, sf_dir: str, fy_end_month: int = 12) -> Period:
    """The period that the orders themselves give: all their months are the
    history, and the window ends with the last complete fiscal year. One
    min/max, which parquet statistics answer."""
    first, last = read(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    if first is None:
        raise ValueError("there are no dated orders")
    return Period.of_history(first, last, fy_end_month)


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No hints: Catalyst and AQE broadcast by the tables' size in bytes.
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                  "c_mktsegment")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
            .select(F.col("c_custkey").alias("customer_key"), "c_name", "c_mktsegment",
                    "n_name", "r_name"))


def assemble_customers(status: DataFrame, dims: DataFrame) -> DataFrame:
    """Customers that signed at least one contract."""
    j = status.join(dims, "customer_key", "left")
    return j.select(
        customer_id_col().alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.lit(UNCLASSIFIED_INDUSTRY).alias("industry"),
        F.col("c_mktsegment").alias("company_segment"),
        F.col("r_name").alias("region"),
        F.col("r_name").alias("acquisition_channel"),
        F.col("n_name").alias("sales_owner"),
        F.col("first_contract_date").alias("signup_date"),
        "first_contract_date", "initial_product_id", "current_product_id",
        "lifecycle_status",
    )


def model_from_orders(spark: SparkSession, sf_dir: str, period: Period,
                      tier_threshold: int = ENTERPRISE_MRR_THRESHOLD,
                      term_months: int = DEFAULT_TERM_MONTHS,
                      checkpoint_segments: bool = False) -> Model:
    """Lazy Model over the driver tables; nothing is computed here.

    With ``checkpoint_segments`` the classified contract months (input of all
    three derived tables) are computed once and written to the checkpoint
    folder, which keeps their customer partitioning and cuts the lineage back
    to the orders scan before revenue, churn and customers are written."""
    events = order_events(read(spark, sf_dir, "orders"))
    segments = lifecycle_segments(contract_months(events, period), period,
                                  tier_threshold, term_months)
    if checkpoint_segments:
        shared_dir(spark)
        segments = segments.checkpoint(eager=True)
    lifecycle = customer_lifecycle(segments, period, tier_threshold, term_months)
    revenue = expand_panel(segments, period)
    churn = churn_facts(lifecycle, events)
    customers = assemble_customers(customer_status(lifecycle),
                                   customer_dimension(spark, sf_dir))
    return Model(customers=customers, products=products_table(spark), revenue=revenue,
                 churn=churn, domains=ORDER_DOMAINS, numbered=expand_panel(segments, period, numbered=True),
                 segments=segments, months=panel_months(segments, period))


def lifecycle_specs(seg: DataFrame, period: Period, tier_threshold: int = ENTERPRISE_MRR_THRESHOLD,
                    term_months: int = DEFAULT_TERM_MONTHS):
    """Lifecycle specs (contract/churn months, pauses, plan changes) read off
    a model's segments, for ``operators.lifecycle``. A gap between
    coverage islands is a pause ending at the reactivation month; a lapse
    at the end is an open pause (or, if never reactivated, the churn)."""
    life = customer_lifecycle(seg, period, tier_threshold, term_months)
    cid = customer_id_col().alias("customer_id")
    lifecycles = life.select(
        cid, month_from_index(F.col("first_ym")).alias("contract_month"),
        F.when(F.col("churned"), month_from_index(F.col("churn_ym"))).alias("churn_month"))
    gaps = seg.where(F.col("after_gap")).select(
        cid, month_from_index(F.col("prev_ym") + term_months).alias("pause_start"),
        month_from_index(F.col("ym")).alias("reactivation_month"))
    lapses = seg.where(F.col("next_ym").isNull()
                       & (F.col("ym") + (term_months - 1) < F.lit(period.last_index))).select(
        cid, month_from_index(F.col("ym") + term_months).alias("pause_start"),
        F.lit(None).cast("date").alias("reactivation_month"))
    changes = seg.select(cid, month_from_index(F.col("ym")).alias("change_month"),
                         product_of(F.col("tier")).alias("product_id"),
                         F.col("closing").cast("long").alias("mrr"))
    return lifecycles, gaps.unionByName(lapses), changes


def model_with_defects(model: Model) -> Model:
    """The order-derived model with the fixed defect rules applied."""
    from ..operators.quality import inject_defects
    return inject_defects(model, DEFECT_DUPLICATE_SEGMENT, DEFECT_FORBIDDEN_FROM_SEGMENT,
                          DEFECT_STATUS_FLIP_SEGMENT, DEFECT_ORPHAN_CHURN_REASON)
