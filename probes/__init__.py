"""Checks on the driver's tables: the same question for Spark and for DuckDB."""
