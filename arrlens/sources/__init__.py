"""Sources and sinks: parquet/CSV/JSON tables and the order-derived model."""

from .orders import ORDER_DOMAINS, model_from_orders, order_period
from .tables import (export_results, load_model, products_table, read_csv_table,
                     read_json, retention_windows, save_model, table_counts,
                     write_json, write_table)

__all__ = [
    "ORDER_DOMAINS", "model_from_orders", "order_period", "export_results",
    "load_model", "products_table", "read_csv_table", "read_json",
    "retention_windows", "save_model", "table_counts", "write_json", "write_table",
]
