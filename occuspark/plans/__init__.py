"""Query plans: operators bound to the driver tables, each with its DuckDB oracle."""
