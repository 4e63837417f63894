"""Suite and runner, query registry and DuckDB oracle SQL."""
