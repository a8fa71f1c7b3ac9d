"""DuckDB statements that say independently what each query must return."""
