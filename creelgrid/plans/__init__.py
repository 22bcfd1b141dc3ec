"""Whole runs: ingest, rebuild, map layers."""
