"""Table schemas, domain values, the reporting period and the four-table model."""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the subscription model's published domains.
# ---------------------------------------------------------------------------
REVENUE_TYPES = ["New", "Recurring", "Expansion", "Upgrade", "Reactivation"]
MOVEMENT_TYPES = ["New", "Expansion", "Upgrade", "Reactivation"]
POST_SALE_TYPES = ["Expansion", "Upgrade", "Reactivation"]
PLAN_TIERS = ["Professional", "Enterprise"]
LIFECYCLE_STATUSES = ["Active", "Churned"]
REFERENCE_SEGMENTS = ["Mid-Market", "Large Enterprise"]
FORBIDDEN_SEGMENT = "SMB"
PRODUCT_ROWS = [
    ("P001", "Professional CRM", "Professional", "Annual", 75, 90000, "Mid-Market"),
    ("P002", "Enterprise CRM", "Enterprise", "Annual", 250, 250000, "Large Enterprise"),
]
CRORE = 10_000_000
MONTHS_PER_YEAR = 12
CHURN_DAY_OF_MONTH = 15
# Report-dataset labels for the long (unpivoted) series.
LOGO_FLOW_SERIES = [("New customers", "new_customers"),
                    ("Permanent churn", "permanently_churned_customers")]
GROWTH_RATE_SERIES = [("ARR growth", "yoy_arr_growth_pct"),
                      ("Active-customer growth", "yoy_active_customer_growth_pct")]

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("plan_tier", T.StringType(), False),
    T.StructField("billing_frequency", T.StringType(), False),
    T.StructField("included_users", T.LongType(), False),
    T.StructField("base_monthly_price_inr", T.LongType(), False),
    T.StructField("target_segment", T.StringType(), False),
])

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("company_name", T.StringType(), True),
    T.StructField("industry", T.StringType(), True),
    T.StructField("company_segment", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("acquisition_channel", T.StringType(), True),
    T.StructField("sales_owner", T.StringType(), True),
    T.StructField("signup_date", T.DateType(), True),
    T.StructField("first_contract_date", T.DateType(), True),
    T.StructField("initial_product_id", T.StringType(), True),
    T.StructField("current_product_id", T.StringType(), True),
    T.StructField("lifecycle_status", T.StringType(), True),
])

REVENUE_SCHEMA = T.StructType([
    T.StructField("revenue_id", T.StringType(), False),
    T.StructField("revenue_month", T.DateType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("revenue_type", T.StringType(), True),
    T.StructField("opening_mrr_inr", T.LongType(), True),
    T.StructField("movement_mrr_inr", T.LongType(), True),
    T.StructField("closing_mrr_inr", T.LongType(), True),
    T.StructField("recognized_revenue_inr", T.LongType(), True),
    T.StructField("arr_run_rate_inr", T.LongType(), True),
])

CHURN_SCHEMA = T.StructType([
    T.StructField("churn_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("churn_date", T.DateType(), True),
    T.StructField("churn_reason", T.StringType(), True),
    T.StructField("mrr_lost_inr", T.LongType(), True),
    T.StructField("tenure_months", T.LongType(), True),
])

TABLE_SCHEMAS = {
    "customers": CUSTOMERS_SCHEMA,
    "products": PRODUCTS_SCHEMA,
    "revenue": REVENUE_SCHEMA,
    "churn": CHURN_SCHEMA,
}
# Load / FK order: parents first.
TABLE_ORDER = ["products", "customers", "revenue", "churn"]

PRIMARY_KEYS = {
    "products": "product_id",
    "customers": "customer_id",
    "revenue": "revenue_id",
    "churn": "churn_id",
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("customers", "initial_product_id", "products", "product_id"),
    ("customers", "current_product_id", "products", "product_id"),
    ("revenue", "customer_id", "customers", "customer_id"),
    ("revenue", "product_id", "products", "product_id"),
    ("churn", "customer_id", "customers", "customer_id"),
    ("churn", "product_id", "products", "product_id"),
]
# Columns declared NOT NULL, plus the primary keys (which SQLite lets be null).
REQUIRED_COLUMNS = {t: [f.name for f in s.fields] for t, s in TABLE_SCHEMAS.items()}


def month_start(d: date) -> date:
    return date(d.year, d.month, 1)


def add_months(d: date, n: int) -> date:
    idx = d.year * 12 + d.month - 1 + n
    return date(idx // 12, idx % 12 + 1, 1)


def month_end_day(d: date) -> date:
    return date(d.year, d.month, calendar.monthrange(d.year, d.month)[1])


def month_index(d: date) -> int:
    return d.year * 12 + d.month - 1


@dataclass(frozen=True)
class Period:
    """Reporting window, report year and the months the model holds.

    ``start``/``end`` are the first and last month of the window that dated
    metrics look at (first of month). The report year ends at ``fy_end_month``
    of ``report_year``. ``history_start``/``history_end`` are the first and
    last month of the stored model (the window, unless given): status, churn
    and all-time metrics see all of them.
    """

    start: date
    end: date
    report_year: int
    fy_end_month: int = 12
    history_start: date | None = None
    history_end: date | None = None

    def __post_init__(self):
        object.__setattr__(self, "start", month_start(self.start))
        object.__setattr__(self, "end", month_start(self.end))
        object.__setattr__(self, "history_start", month_start(self.history_start or self.start))
        object.__setattr__(self, "history_end", month_start(self.history_end or self.end))
        if self.start > self.end:
            raise ValueError("period start after end")
        if self.history_start > self.start or self.history_end < self.end:
            raise ValueError("the window must lie within the history")

    @classmethod
    def of_history(cls, first: date, last: date, fy_end_month: int = 12, months: int = 36) -> Period:
        """The window of ``months`` months that ends with the last fiscal year
        complete by the month of ``last`` (shorter if the history is); without
        a complete year, the fiscal year that ``last`` lies in is reported."""
        first, last = month_start(first), month_start(last)
        year = last.year if last.month >= fy_end_month else last.year - 1
        end = date(year, fy_end_month, 1)
        if end < first:
            end, year = last, year + 1
        return cls(max(first, add_months(end, 1 - months)), end, year, fy_end_month, first, last)

    @property
    def year_end(self) -> date:
        """Ending month of the report year (the 'ending base' month)."""
        return date(self.report_year, self.fy_end_month, 1)

    @property
    def year_start(self) -> date:
        return add_months(self.year_end, -11)

    @property
    def year_end_day(self) -> date:
        return month_end_day(self.year_end)

    @property
    def prior_year_end(self) -> date:
        return add_months(self.year_end, -12)

    @property
    def two_years_back(self) -> date:
        return add_months(self.year_end, -24)

    @property
    def end_day(self) -> date:
        """Last calendar day of the window (upper bound for event dates)."""
        return month_end_day(self.end)

    @property
    def n_history_months(self) -> int:
        return self.last_index - self.first_index + 1

    @property
    def first_index(self) -> int:
        """Month number of the model's first month."""
        return month_index(self.history_start)

    @property
    def last_index(self) -> int:
        """Month number of the model's last month."""
        return month_index(self.history_end)

    def retention_windows(self) -> list[tuple[int, date, date]]:
        """(year, start_month, end_month) for every fiscal year whose opening
        month lies inside the window and whose year end is at most the report
        year end."""
        out = []
        y = self.report_year
        while True:
            end_m = date(y, self.fy_end_month, 1)
            start_m = add_months(end_m, -12)
            if start_m < self.start:
                break
            if end_m <= self.end:
                out.append((y, start_m, end_m))
            y -= 1
        return sorted(out)


@dataclass(frozen=True)
class Domains:
    """Controlled values checked by the quality gates."""

    segments: tuple[str, ...] = tuple(REFERENCE_SEGMENTS)
    revenue_types: tuple[str, ...] = tuple(REVENUE_TYPES)
    plan_tiers: tuple[str, ...] = tuple(PLAN_TIERS)
    lifecycle_statuses: tuple[str, ...] = tuple(LIFECYCLE_STATUSES)
    forbidden_segment: str = FORBIDDEN_SEGMENT


@dataclass
class Model:
    """The four tables. ``numbered`` is the revenue table with ``customer_no``,
    a number that stands for the customer id (for bitmaps); ``segments`` are the
    contract months that the panel was built from, ``months`` its rows before
    ``panel_rows`` makes them. All three may be missing."""

    customers: DataFrame
    products: DataFrame
    revenue: DataFrame
    churn: DataFrame
    domains: Domains = field(default_factory=Domains)
    numbered: DataFrame | None = None
    segments: DataFrame | None = None
    months: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {"products": self.products, "customers": self.customers,
                "revenue": self.revenue, "churn": self.churn}
