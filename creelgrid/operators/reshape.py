"""Unions, wide/long changes and column housekeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import NULL_TOKENS, blank_to_null

# Fixed value: how map layers write "no data".
NO_DATA = -9999

# Names of the block slots of the wide location table.
SLOT_NAMES = (
    "Bk1Bx1a", "Bk1Bx1b", "Bk1Bx1c", "Bk2Bx2a", "Bk2Bx2b", "Bk2Bx2c",
    "extrablock7", "extrablock8", "extrablock9", "extrablock10", "extrablock11",
)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_strict(*frames: DataFrame) -> DataFrame:
    """Stack frames that must have the same columns."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def schema_difference(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """Columns only ``a`` has, columns only ``b`` has."""
    return [c for c in a.columns if c not in b.columns], [c for c in b.columns if c not in a.columns]


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop the columns without a single value, after one pass that counts them all."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def blanks_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Every text column trimmed, with the NULL tokens as NULL.

    Raw tables pass here once, where they are read; all other operators rely on it.
    """
    return df.select(*[blank_to_null(F.col(f"`{c}`"), tokens).alias(c) for c in df.columns])


def map_columns(df: DataFrame, columns: Sequence[str], function) -> DataFrame:
    """Apply one expression to each of the columns."""
    return df.withColumns({c: function(F.col(c)) for c in columns})


def align_to(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of ``other``, in its order."""
    return df.select(*other.columns)


def named_first(df: DataFrame, *first: str) -> DataFrame:
    """Put some columns first, the rest after."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def present_of(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def blocks_to_rows(df: DataFrame, columns: Sequence[str], value: str = "Block") -> DataFrame:
    """One row per non-NULL block column."""
    ids = [c for c in df.columns if c not in columns]
    return df.unpivot(ids, list(columns), "__slot", value).drop("__slot").filter(F.col(value).isNotNull())


def blocks_to_slots(df: DataFrame, key: str, heads: Sequence[str] = (), value: str = "Block") -> DataFrame:
    """The published wide form: numbered block columns per key, blocks in order.

    ``df`` holds each block of a key once, so a key has at most as many rows as
    the map has blocks. Blocks beyond the published slots are listed as text in
    ``more_blocks``. ``heads`` are columns that depend on the key.
    """
    numbered = df.select(
        key, *heads, value, F.row_number().over(Window.partitionBy(key).orderBy(value)).alias("__n")
    )
    block, n = F.col(value), F.col("__n")
    slots = [F.max(F.when(n == i, block)).alias(name) for i, name in enumerate(SLOT_NAMES, start=1)]
    more = F.concat_ws(";", F.array_sort(F.collect_list(F.when(n > len(SLOT_NAMES), block))))
    wide = numbered.groupBy(key, *heads).agg(*slots, more.alias("more_blocks"))
    return wide.withColumn("more_blocks", F.nullif(F.col("more_blocks"), F.lit("")))


def wide_values(
    df: DataFrame, keys: Sequence[str], names_from: Column, values: dict[str, str], names: Sequence[str]
) -> DataFrame:
    """Long to wide over an explicit list of names.

    ``values`` maps a source column to the prefix of its new columns; an empty
    prefix uses the name alone.
    """
    pivoted = (
        df.withColumn("__name", names_from)
        .groupBy(*keys)
        .pivot("__name", list(names))
        .agg(*[F.first(c).alias(c) for c in values])
    )
    single = len(values) == 1
    return pivoted.select(
        *keys,
        *[
            F.col(f"`{n}`" if single else f"`{n}_{c}`").alias(f"{prefix}_{n}" if prefix else n)
            for c, prefix in values.items()
            for n in names
        ],
    )


def fill_no_data(df: DataFrame, value: int = NO_DATA) -> DataFrame:
    """Every NULL becomes the sentinel; text columns get it as text."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(value).fillna(str(value), subset=text) if text else df.fillna(value)
