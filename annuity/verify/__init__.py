"""DuckDB oracle SQL for every registered query (used by the driver and tests)."""
