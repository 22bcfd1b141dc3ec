"""Yearly files to one table per kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import KINDS, find_headers, malformed_rows, read_raw, read_yearly
from ..sources.writers import write_table


def ingest(
    spark: SparkSession, folder: str, out: str, kinds=KINDS, file_format: str = "csv"
) -> dict[str, DataFrame]:
    """Stack the files of each kind and write one text-typed table per kind.

    For delimited files, the headers of all kinds are found in one job, and the rows that do not
    fit their header are counted per file.
    """
    headers: dict = {}
    if file_format == "csv":
        headers = find_headers(spark, folder, kinds)
        for k in kinds:
            if headers[k]:
                write_table(malformed_rows(spark, folder, k, headers[k]), f"{out}/{k}_malformed")
    return {k: write_table(read_yearly(spark, folder, k, file_format, headers=headers.get(k)), f"{out}/{k}") for k in kinds}


def ingest_old(spark: SparkSession, paths: dict[str, str], out: str) -> dict[str, DataFrame]:
    """Write the older files as tables too, so that a rebuild parses each text once."""
    return {name: write_table(read_raw(spark, path), f"{out}/{name}") for name, path in paths.items()}
