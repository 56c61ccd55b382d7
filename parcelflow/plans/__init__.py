"""Plans: the query catalog, the DuckDB oracle text and the ETL pipeline."""
