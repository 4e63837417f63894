"""DataFrame operators: panel, KPIs, checks, headline, reconciliation,
report datasets and manifest."""
