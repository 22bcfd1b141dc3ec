"""Relational operators: functions from DataFrames to lazy DataFrames."""
