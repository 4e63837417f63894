"""arrlens: recurring-revenue analytics (MRR/ARR, retention, churn, growth
quality) as Spark DataFrame operators.

Layout:
    schema       table schemas, domains, Period, Model
    functions/   column helpers (month arithmetic, null-safe ratios, scaling)
    sources/     parquet/CSV/JSON sources and sinks; order tables -> Model
    operators/   panel builder, KPI queries, quality and constraint checks,
                 headline, reconciliation, report datasets, manifest
    plans/       Suite (all results for one model and period), the gated
                 runner, the query registry and the DuckDB oracle SQL
"""

from .schema import Domains, Model, Period

__all__ = ["Domains", "Model", "Period"]
