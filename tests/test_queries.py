"""Every registered query against its SQL, on the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from probes import casting
from probes.check import compare
from probes.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in casting.SOURCES:
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    good, note = compare(spark, duck, name, SF)
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert {"Block", "Catch", "Trip", "Samples", "CPUA_All"} <= set(df.columns)
    assert df.count() > 0
