"""Assembled plans: medallion layers, SQL scripts, the weather load, the DuckDB oracle."""
