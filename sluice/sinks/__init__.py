"""Sinks: native Parquet table with a manifest, JDBC, staged files."""
