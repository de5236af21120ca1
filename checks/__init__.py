"""DuckDB statements that the registered queries are compared with."""
