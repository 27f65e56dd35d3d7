"""Fixtures over the given tables, the queries run on them and what DuckDB expects."""
