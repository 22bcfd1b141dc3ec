"""Text, id, date and number expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast to double also reads ``12d``, ``NaN``, ``Infinity`` and hexadecimal; all of
# them need a letter other than the exponent's.
NOT_A_DIGIT = "[A-DF-Za-df-z]"

# NULL tokens of the older files, the block sentinel, the least length
# of a block code, the default location.
NULL_TOKENS = ("", ".", "NA")
BLOCK_SENTINEL = "9999999"
MIN_CODE = 5
DEFAULT_LOCN = "1"

# Year ranges of the grouped map layer.
YEAR_RANGES = (("04_09", 2004, 2009), ("10_15", 2010, 2015), ("16_20", 2016, 2020), ("21_23", 2021, 2023))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str, tokens: Iterable[str] = ("",)) -> Column:
    """Trimmed text, or NULL where it equals one of the tokens."""
    text = F.trim(col(c))
    return F.when(~text.isin(list(tokens)), text)


def strip_zeros(c: Column | str) -> Column:
    """``045`` to ``45``, for columns that hold numbers as text."""
    text = col(c)
    return F.when(text.startswith("0"), F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise(text)


def sentinel_to_null(c: Column | str, sentinel: str) -> Column:
    return F.nullif(col(c), F.lit(sentinel))


def to_number(c: Column | str) -> Column:
    """Text to double, NULL when it is not a plain number."""
    text = col(c)
    return F.when(~text.rlike(NOT_A_DIGIT), text.try_cast("double"))


def joined_box(block: Column | str, box: Column | str) -> Column:
    """``block-box`` as it stands, a missing part being empty."""
    return F.concat(F.coalesce(col(block), F.lit("")), F.lit("-"), F.coalesce(col(box), F.lit("")))


def is_box(code: Column | str) -> Column:
    return F.length(col(code)) >= MIN_CODE


def format_box(block: Column | str, box: Column | str) -> Column:
    """``block-box``; NULL when it is too short to name a block."""
    code = joined_box(block, box)
    return F.when(is_box(code), code)


def default_locn(c: Column | str) -> Column:
    """Location number as text; NULL and 0 become the first location."""
    return F.when(col(c).rlike("[^0]"), strip_zeros(c)).otherwise(F.lit(DEFAULT_LOCN))


def trip_location_id(id_code: Column | str, locn: Column | str) -> Column:
    return F.concat(col(id_code), col(locn))


def prefixed(c: Column | str, prefix: str = "ID") -> Column:
    return F.concat(F.lit(prefix), col(c))


def id_date(c: Column | str, is_prefixed: bool = False) -> Column:
    """The day written inside a trip id: characters 6-13, or 8-15 after the prefix."""
    return F.try_to_date(F.substring(col(c), 8 if is_prefixed else 6, 8), "yyyyMMdd")


def id_month(c: Column | str, is_prefixed: bool = False) -> Column:
    return F.month(id_date(c, is_prefixed))


def month_label(month: Column | str) -> Column:
    """Month as ``19MM``, the label time-enabled layers use."""
    return F.concat(F.lit("19"), F.lpad(col(month).cast("string"), 2, "0"))


def year_range(year: Column | str, ranges=YEAR_RANGES) -> Column:
    """Range label of a year, NULL outside all ranges."""
    out = F.lit(None).cast("string")
    number = to_number(col(year).cast("string"))
    for label, low, high in reversed(list(ranges)):
        out = F.when(number.between(low, high), F.lit(label)).otherwise(out)
    return out


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, NULL when ``b`` is zero."""
    return F.try_divide(col(a), col(b))


def round_even(c: Column | str, digits: int) -> Column:
    return F.bround(col(c), digits)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def sum_or_zero(c: Column | str) -> Column:
    """Sum that skips NULL and is 0 for a group of only NULLs."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def stable_sum(c: Column | str) -> Column:
    """`sum_or_zero` without the digits that depend on the order of summation.

    Rounded rates would otherwise differ between runs where a sum lies on a tie.
    """
    return F.round(sum_or_zero(c), 9)


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that is never NULL."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def none_given(*cols: Column | str) -> Column:
    """True when every column is NULL."""
    return F.coalesce(*[col(c) for c in cols]).isNull()


def distinct_given(*cols: Column | str) -> Column:
    """How many different non-NULL values the columns hold in one row."""
    return F.size(F.array_distinct(F.array_compact(F.array(*[col(c) for c in cols]))))
