"""Operators: SQL-text builders for nested JSON, and DataFrame-to-DataFrame steps."""
