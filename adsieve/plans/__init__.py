"""Job plans: the batch job, the query catalog and the DuckDB oracle SQL."""
