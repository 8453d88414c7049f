"""Query registry (Spark) and the independent DuckDB oracle SQL."""
