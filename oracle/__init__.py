"""Check SQL for the registered queries, in DuckDB's dialect."""
