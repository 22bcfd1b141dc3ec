"""Copies, ambiguous keys and merged locations.

Nothing here uses a window over raw rows or carries whole rows through an aggregate:
counts by key are partial hash aggregates, so a key with a third of all rows costs one
row per map task. The keys that occur more than once are written as a table of their
own; where Spark's size check finds them small, which keys that should be unique are,
they are broadcast and no other row moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reasons
from ..session import stage_table
from .joins import skew_join
from .rejects import REASON, Stage


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Every row with the size of its group."""
    return skew_join(df, group_sizes(df, keys, name), keys, "left", null_safe=True)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of more than one row, as a written table; NULL is a key."""
    return stage_table(group_sizes(df, keys).filter("n > 1").select(*keys), "repeated")


def drop_ambiguous(df: DataFrame, keys: Sequence[str], reason: str) -> Stage:
    """Remove every copy of a key that occurs more than once."""
    repeated = repeated_keys(df, keys)
    rejects = skew_join(df, repeated, keys, "left_semi", null_safe=True)
    kept = skew_join(df, repeated, keys, "left_anti", null_safe=True)
    return Stage(kept, rejects.withColumn(REASON, F.lit(reason)), (reason,))


def dup_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row."""
    return group_sizes(df, keys).filter("n > 1")


def dup_rate(df: DataFrame, key: str) -> DataFrame:
    """Share of ids seen more than once, and the largest group."""
    return group_sizes(df, [key]).agg(
        F.count(F.lit(1)).alias("ids"),
        F.max("n").alias("max_rows"),
        F.bround(F.avg(F.when(F.col("n") > 1, 100.0).otherwise(0.0)), 2).alias("percent_duplicated"),
    )


def fingerprint(*columns: str) -> Column:
    """64 bits over the columns, NULL a value of its own. Only rows of one key are compared by it."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns])


def extremes(mark: str) -> list[Column]:
    return [F.min(mark).alias("__least"), F.max(mark).alias("__most")]


def alike() -> Column:
    """After `extremes`: one fingerprint in the whole group."""
    return F.col("__least") == F.col("__most")


def consolidate_blocks(
    df: DataFrame, key: str, attributes: Sequence[str], block: str = "Block"
) -> Stage:
    """Merge the blocks of rows that agree on all attributes; reject the other ids.

    Input is one row per (row, block). An id is kept when all its rows carry the
    same attributes; it then has one row per different block, with their number
    in ``total_blocks``. The different rows are made once; one aggregate of them by id
    gives the number and, by the extremes of a fingerprint of the attributes, whether
    they agree. Its join with them can be split. Rejected are the merged rows: one per id
    and attributes.
    """
    rows = df.select(key, *attributes, block).distinct()
    counted = F.count(F.lit(1)).cast("int").alias("total_blocks")
    ids = rows.withColumn("__mark", fingerprint(*attributes)).groupBy(key).agg(counted, *extremes("__mark"))
    agreed = ids.filter(alike()).select(key, "total_blocks")
    in_conflict = ids.filter(~alike()).select(key)
    kept = skew_join(rows, agreed, [key], null_safe=True)
    rejects = skew_join(df.select(key, *attributes).distinct(), in_conflict, [key], "left_semi", null_safe=True)
    return Stage(
        kept,
        rejects.withColumn(REASON, F.lit(reasons.LOCATION_CONFLICT)),
        (reasons.LOCATION_CONFLICT,),
    )


def same_blocks(df: DataFrame, key: str, block: str = "Block") -> DataFrame:
    """The sorted set of blocks per key, which is as large as one location's blocks."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(block)).alias("blocks"))
