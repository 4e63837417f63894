"""Panel from explicit lifecycle specs (P3, P4, P5, P8 in their spec form).

Inputs, all keyed by ``customer_id``:

* ``lifecycles``: ``contract_month`` (first of month) and ``churn_month``
  (first month without revenue, null when never churned).
* ``pauses``: ``pause_start`` and ``reactivation_month`` (null = still paused);
  no revenue rows in ``[pause_start, reactivation_month)``. Any number per
  customer.
* ``plan_changes``: ``change_month``, ``product_id``, ``mrr``: the plan and
  MRR in force from that month on (the contract month included); the latest
  change at or before a month is carried forward, and of changes in the same
  month the one with the largest MRR (then the highest plan) counts.

Plan, a sweep line: every spec becomes events on a customer's time line, +1
and -1 for contracts and pauses, and plan states. Events are reduced two-phase
to one per (customer, month) in fixed-width buffers, so a flood of input rows
collapses map-side; then one shuffle brings each customer's events together,
running sums over them tell what is active, and the months of each stretch are
exploded last. Work and shuffle follow the number of changes, not of months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.months import month_from_index, month_index
from ..schema import PLAN_TIERS, Period

#: Bits of an MRR below which a month's plan number stands beside it.
PLAN_BITS = 16


def _events(df: DataFrame, month: Column, active: int = 0, paused: int = 0, state: Column | None = None) -> DataFrame:
    """Events of one kind; those without a month never come."""
    return df.select("customer_id", month.alias("ym"), F.lit(active).cast("long").alias("active"),
                     F.lit(paused).cast("long").alias("paused"), (F.lit(None) if state is None else state).cast("long").alias("state"))


def _plan_numbers(plan_changes: DataFrame, products: DataFrame) -> DataFrame:
    """(product_id, rank, plan): the plans that changes name, numbered by tier
    (unknown ones first) and id; a row for each plan, 65,535 at most."""
    tier = F.array_position(F.array(*[F.lit(t) for t in PLAN_TIERS]), F.col("plan_tier"))
    known = products.select(F.col("product_id").alias("known_id"), tier.alias("rank"))
    named = plan_changes.select("product_id").distinct()
    plans = named.join(known, named["product_id"].eqNullSafe(known["known_id"]), "left").select("product_id", "rank")
    # One window over the plans: a few rows.
    number = F.row_number().over(Window.orderBy(F.col("rank").asc_nulls_first(), F.col("product_id").asc_nulls_first())).cast("long")
    most = F.raise_error(F.lit(f"more than {(1 << PLAN_BITS) - 1} plans")).cast("long")
    return plans.withColumn("plan", F.when(number < (1 << PLAN_BITS), number).otherwise(most))


def lifecycle_timeline(lifecycles: DataFrame, pauses: DataFrame, plan_changes: DataFrame, plans: DataFrame, period: Period) -> DataFrame:
    """Stretches of months (``ym`` to ``last_ym``) in which a customer is active
    on one plan: (customer_id, ym, last_ym, state, and of the stretch before:
    prev_last, prev_state). ``state`` holds the MRR and the plan's number."""
    start, churn = month_index("contract_month"), month_index("churn_month")
    lives = lifecycles.where((start <= period.last_index) & (F.col("churn_month").isNull() | (churn > start)))
    pause, back = month_index("pause_start"), month_index("reactivation_month")
    gaps = pauses.where((pause <= period.last_index) & (F.col("reactivation_month").isNull() | (back > pause)))
    same = plan_changes["product_id"].eqNullSafe(plans["product_id"])
    changes = plan_changes.where("mrr is not null").join(plans, same).select(
        "customer_id", "change_month", (F.col("mrr").cast("long") * (1 << PLAN_BITS) + F.col("plan")).alias("state"))
    events = (_events(lives, start, active=1)
              .union(_events(lives.where("churn_month is not null"), churn, active=-1))
              .union(_events(gaps, pause, paused=1))
              .union(_events(gaps.where("reactivation_month is not null"), back, paused=-1))
              .union(_events(changes, month_index("change_month"), state=F.col("state"))))
    monthly = events.where(F.col("ym") <= period.last_index).groupBy("customer_id", "ym").agg(
        F.sum("active").alias("active"), F.sum("paused").alias("paused"), F.max("state").alias("state"))
    line = Window.partitionBy("customer_id").orderBy("ym")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = monthly.select(
        "customer_id", "ym", F.sum("active").over(upto).alias("active"), F.sum("paused").over(upto).alias("paused"),
        F.last("state", ignorenulls=True).over(upto).alias("state"),
        (F.coalesce(F.lead("ym").over(line), F.lit(period.last_index + 1)) - 1).alias("last_ym"))
    return swept.where("active > 0 and paused = 0").select(
        "customer_id", "ym", "last_ym", "state", F.lag("last_ym").over(line).alias("prev_last"), F.lag("state").over(line).alias("prev_state"))


def panel_from_lifecycles(lifecycles: DataFrame, pauses: DataFrame, plan_changes: DataFrame,
                          products: DataFrame, period: Period) -> DataFrame:
    """Revenue rows (same schema as the revenue table) of the model's months.
    Months are classified over the full history first, then clipped."""
    plans = F.broadcast(_plan_numbers(plan_changes, products))  # 65,535 rows at most, or it raises
    line = lifecycle_timeline(lifecycles, pauses, plan_changes, plans, period)

    def plan_of(state: str) -> Column:
        return F.col(state) % (1 << PLAN_BITS)

    def mrr_of(state: str) -> Column:
        return F.shiftright(state, PLAN_BITS)
    ranks = F.broadcast(plans.select(F.col("plan").alias("prev_plan"), F.col("rank").alias("prev_rank")))
    own = line.withColumn("plan", plan_of("state")).withColumn("prev_plan", plan_of("prev_state"))
    own = own.join(plans, "plan", "left").join(ranks, "prev_plan", "left").select(
        "customer_id", "ym", "last_ym", "prev_last", "product_id", "rank", "prev_rank",
        mrr_of("state").alias("closing"), mrr_of("prev_state").alias("prev_closing"))
    # P6 precedence, on the first month of a stretch; its other months are Recurring.
    first_type = (F.when(F.col("prev_last").isNull(), F.lit("New"))
                  .when(F.col("prev_last") < F.col("ym") - 1, F.lit("Reactivation"))
                  .when(F.col("rank") > F.col("prev_rank"), F.lit("Upgrade"))
                  .when(F.col("closing") > F.col("prev_closing"), F.lit("Expansion"))
                  .otherwise(F.lit("Recurring")))
    low = F.greatest(F.col("ym"), F.lit(period.first_index).cast("long"))
    months = own.withColumn("first_type", first_type).where(F.col("last_ym") >= low).withColumn(
        "month", F.explode(F.sequence(low, F.col("last_ym"))))
    first = F.col("month") == F.col("ym")
    opening = (F.when(first & F.col("first_type").isin("New", "Reactivation"), F.lit(0))
               .when(first, F.col("prev_closing")).otherwise(F.col("closing")))
    day = month_from_index("month")
    return months.select(
        F.concat(F.lit("R"), F.col("customer_id"), F.lit("-"), F.date_format(day, "yyyyMM")).alias("revenue_id"),
        day.alias("revenue_month"), "customer_id", "product_id",
        F.when(first, F.col("first_type")).otherwise(F.lit("Recurring")).alias("revenue_type"),
        opening.cast("long").alias("opening_mrr_inr"),
        (F.col("closing") - opening).cast("long").alias("movement_mrr_inr"),
        F.col("closing").cast("long").alias("closing_mrr_inr"),
        F.col("closing").cast("long").alias("recognized_revenue_inr"),
        (F.col("closing") * 12).cast("long").alias("arr_run_rate_inr"),
    )
