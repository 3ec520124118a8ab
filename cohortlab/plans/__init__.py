"""Query plans over the driver's test tables (queries + DuckDB oracles)."""
