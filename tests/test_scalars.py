import datetime

import pytest
from pyspark.sql import functions as F

from creelgrid.functions import scalars as X

from conftest import text_frame


def one(spark, expression, **columns):
    names = list(columns)
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{n} string" for n in names)) if names else spark.range(1)
    return df.select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "block, box, expected",
    [
        ("123", None, None),
        ("1035", None, "1035-"),
        ("123", "45", "123-45"),
        (None, "1234", "-1234"),
        (None, None, None),
        ("NA1", "2", "NA1-2"),
    ],
)
def test_block_code(spark, block, box, expected):
    assert one(spark, X.format_box("b", "x"), b=block, x=box) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12.0), (" 1.5 ", 1.5), ("1e3", 1000.0), (".5", 0.5), ("-3.", -3.0), ("12d", None), ("NaN", None),
     ("Infinity", None), ("", None), (None, None), ("LNGCD", None)],
)
def test_to_number(spark, text, expected):
    assert one(spark, X.to_number("t"), t=text) == expected


@pytest.mark.parametrize("text, expected", [("045", "45"), ("000", "0"), ("0", "0"), ("10", "10"), ("0a", "0a"), (None, None)])
def test_strip_zeros(spark, text, expected):
    assert one(spark, X.strip_zeros("t"), t=text) == expected


@pytest.mark.parametrize("text, expected", [(None, "1"), ("0", "1"), ("00", "1"), ("2", "2"), ("02", "2"), ("10", "10")])
def test_default_locn(spark, text, expected):
    assert one(spark, X.default_locn("t"), t=text) == expected


def test_blank_tokens(spark):
    df = text_frame(spark, ["t"], [("",), (" . ",), ("NA",), (" x ",), (None,)])
    assert [r.v for r in df.select(X.blank_to_null("t", X.NULL_TOKENS).alias("v")).collect()] == [None, None, None, "x", None]
    assert [r.v for r in df.select(X.blank_to_null("t").alias("v")).collect()] == [None, ".", "NA", "x", None]


def test_id_date_and_month(spark):
    assert one(spark, X.id_date("t"), t="1234520160712001") == datetime.date(2016, 7, 12)
    assert one(spark, X.id_month("t", is_prefixed=True), t="ID1234520160712001") == 7
    assert one(spark, X.id_date("t"), t="1234520161340001") is None
    assert one(spark, X.month_label(F.lit(7))) == "1907"
    assert one(spark, X.month_label(F.lit(11))) == "1911"


@pytest.mark.parametrize("year, label", [("2004", "04_09"), ("2009", "04_09"), ("2010", "10_15"), ("2020", "16_20"), ("2023", "21_23"), ("2003", None), (None, None)])
def test_year_range(spark, year, label):
    assert one(spark, X.year_range("t"), t=year) == label


def test_rounding_and_ratio(spark):
    assert one(spark, X.round_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, X.round_even(F.lit(0.375), 2)) == 0.38
    assert one(spark, X.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, X.is_in("t", ["1"]), t=None) is False
    assert one(spark, X.distinct_given("a", "b", "c"), a="x", b=None, c="x") == 1
    assert one(spark, X.none_given("a", "b"), a=None, b=None) is True
    assert one(spark, X.sentinel_to_null("a", X.BLOCK_SENTINEL), a="9999999") is None


def test_null_id_stays_null(spark):
    assert one(spark, X.trip_location_id("a", "b"), a=None, b="1") is None
