"""Registered queries over the given tables and their DuckDB oracle SQL."""
