"""Sinks: Parquet tables and JDBC."""
