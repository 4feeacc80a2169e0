"""Sinks: Parquet and CSV files, JDBC."""
