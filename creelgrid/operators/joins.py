"""Joins that keep NULL keys where asked and survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]


def _pairs(on: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def _same(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[Key], how: str = "inner", null_safe: bool = False, also: Sequence[Column] = ()
) -> DataFrame:
    """Equi-join whose left side may hold a third of all rows under one key.

    AQE splits a skewed partition only when both inputs of the join are fresh
    shuffles. A right side that was just grouped by the same key would be joined
    in place, without one, and the hot key would stay in one task. A hash of the
    keys as an additional join key asks for the shuffle; the right side is the
    grouped and therefore smaller one. Small right sides are still broadcast, by
    Spark's own size check. Key columns of the right side are dropped. ``also`` are
    further conditions.
    """
    pairs = _pairs(on)
    right = right.select(
        *[F.col(r).alias(f"__r{i}") for i, (_, r) in enumerate(pairs)],
        *[c for c in right.columns if c not in {r for _, r in pairs}],
        F.xxhash64(*[F.col(r) for _, r in pairs]).alias("__rh"),
    )
    left = left.withColumn("__lh", F.xxhash64(*[F.col(l) for l, _ in pairs]))
    keys = [_same(left[l], right[f"__r{i}"], null_safe) for i, (l, _) in enumerate(pairs)]
    condition = reduce(Column.__and__, [*keys, *also], left["__lh"] == right["__rh"])
    helpers = ["__lh", "__rh", *[f"__r{i}" for i in range(len(pairs))]]
    return left.join(right, condition, how).drop(*helpers)


def keyed_join(
    left: DataFrame, right: DataFrame, on: Sequence[Key], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join on differently named keys; the right keys are dropped."""
    pairs = _pairs(on)
    right = right.withColumnsRenamed({r: f"__r{i}" for i, (_, r) in enumerate(pairs)})
    keys = [_same(left[l], right[f"__r{i}"], null_safe) for i, (l, _) in enumerate(pairs)]
    joined = left.join(right, reduce(Column.__and__, keys), how)
    return joined.drop(*[f"__r{i}" for i in range(len(pairs))])


def full_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_safe: Sequence[str] | None = None,
    split_right: bool = True,
    together: str | None = None,
) -> DataFrame:
    """Full outer join in which NULL keys match; keys are coalesced under the left name.

    ``null_safe`` names the left keys that can be NULL, if not all. Other columns that
    exist on both sides get the suffixes. A full join cannot be split by AQE, so it is
    made of two that can: the left join, and the rows of the right side without a key on
    the left, which meet one row per key. A key with a third of the rows of either side
    is split, on the right only with ``split_right``, which costs a shuffle of the left keys;
    a side with few rows per key goes right, without it. Both inputs are read twice and
    should be tables or cheap to make again.

    ``together`` is the left name of a key under which the right side has few rows: rows of
    the left join meet by it alone and compare the other keys there, so neighbours of one
    such key stay neighbours in the shuffle and compress as such.
    """
    pairs = _pairs(on)
    lk, rk = [l for l, _ in pairs], [r for _, r in pairs]
    clash = (set(left.columns) - set(lk)) & (set(right.columns) - set(rk))
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    rest_left = [c for c in left.columns if c not in lk]
    rest_right = [c for c in right.columns if c not in rk]
    matched = _split_join(left, right, pairs, "left", null_safe) if together is None else _together_join(left, right, pairs, together, null_safe)
    keys = left.select(*[F.col(l).alias(f"__k{i}") for i, l in enumerate(lk)])
    back = [(r, f"__k{i}") for i, r in enumerate(rk)]
    safe = None if null_safe is None else [r for l, r in pairs if l in null_safe]
    if split_right:
        alone = _split_join(right, keys.distinct(), back, "left_anti", safe)
    else:
        # a struct is never NULL, so its equality is null-safe and the shuffle of the keys serves the join
        boxed = {r for r, _ in back if safe is None or r in safe}
        keys = keys.select(*[(F.struct(k) if r in boxed else F.col(k)).alias(k) for r, k in back]).distinct()
        same = [(F.struct(right[r].alias(k)) if r in boxed else right[r]) == keys[k] for r, k in back]
        alone = right.join(keys, reduce(Column.__and__, same), "left_anti")
    alone = alone.select(*[F.col(r).alias(l) for l, r in pairs], *rest_right)
    return matched.select(*lk, *rest_left, *rest_right).unionByName(alone, allowMissingColumns=True)


def _split_join(left: DataFrame, right: DataFrame, pairs, how: str, null_safe: Sequence[str] | None) -> DataFrame:
    """`skew_join` with some of the keys null-safe (those in ``null_safe``, or all)."""
    if null_safe is None or set(null_safe) >= {l for l, _ in pairs}:
        return skew_join(left, right, pairs, how, null_safe=True)
    if not null_safe:
        return skew_join(left, right, pairs, how)
    # a key that may be NULL becomes one that says so and one that is never NULL
    flags = [(f"__n{i}", f"__m{i}") for i, (l, _) in enumerate(pairs) if l in null_safe]
    marked_left = left.withColumns({f"__n{i}": F.struct(F.col(l)) for i, (l, _) in enumerate(pairs) if l in null_safe})
    marked_right = right.withColumns({f"__m{i}": F.struct(F.col(r).alias(l)) for i, (l, r) in enumerate(pairs) if l in null_safe})
    marked_right = marked_right.drop(*[r for l, r in pairs if l in null_safe])
    on = [(l, r) for l, r in pairs if l not in null_safe] + flags
    return skew_join(marked_left, marked_right, on, how).drop(*[f for f, _ in flags])


def _together_join(left: DataFrame, right: DataFrame, pairs, together: str, null_safe: Sequence[str] | None) -> DataFrame:
    """Left join that shuffles by one key. Equality of the others is written as an order, which is no key to Spark."""

    def same(l: str, r: str) -> Column:
        equal = (F.col(l) >= F.col(r)) & (F.col(l) <= F.col(r))
        return F.coalesce(equal, F.col(l).isNull() & F.col(r).isNull()) if null_safe is None or l in null_safe else equal

    others = {r: f"__o{i}" for i, (l, r) in enumerate(pairs) if l != together}
    conditions = [same(l, others[r]) for l, r in pairs if r in others]
    safe = null_safe is None or together in null_safe
    on = [(l, r) for l, r in pairs if l == together]
    return skew_join(left, right.withColumnsRenamed(others), on, "left", safe, conditions).drop(*others.values())


def merge_unique(left: DataFrame, right: DataFrame, on: Sequence[str], near: Sequence[str] = ()) -> DataFrame:
    """Full join of two frames that have a row per key, in one shuffle: stacked and grouped.

    NULL keys match. The other columns must differ in name. ``near`` are those of the keys by
    which rows move, if not all: neighbours that agree on them stay so and compress as such.
    """
    rest = [c for c in (*left.columns, *right.columns) if c not in on]
    stacked = left.unionByName(right, allowMissingColumns=True)
    return (stacked.repartition(*near) if near else stacked).groupBy(*on).agg(*[F.max(c).alias(c) for c in rest])


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every shared column, NULL matching NULL."""
    shared = [c for c in left.columns if c in right.columns]
    return skew_join(left, right, shared, "left", null_safe=True)


def anti_all_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without an equal row in ``right`` on all shared columns; duplicates stay."""
    shared = [c for c in left.columns if c in right.columns]
    return skew_join(left, right.select(shared).distinct(), shared, "left_anti", null_safe=True)


def rows_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Rows whose value occurs in another table's column."""
    values = other.select(F.col(other_column or column).alias("__v")).distinct()
    return skew_join(df, values, [(column, "__v")], "left_semi", null_safe=True)


def rows_not_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Rows whose value does not occur there; a NULL counts as a value."""
    values = other.select(F.col(other_column or column).alias("__v")).distinct()
    return skew_join(df, values, [(column, "__v")], "left_anti", null_safe=True)


def flag_known(
    df: DataFrame, column: str, other: DataFrame, other_column: str, flag: str
) -> DataFrame:
    """Every row of ``df`` plus a boolean: does the value occur in ``other``?

    One left join serves both the kept and the rejected side.
    """
    values = other.select(F.col(other_column).alias("__v")).distinct().withColumn(flag, F.lit(True))
    joined = skew_join(df, values, [(column, "__v")], "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def join_audit(before: DataFrame, after: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Ids whose row count changed through a join."""
    n_before = before.groupBy(key).agg(F.count(F.lit(1)).alias("n_before"))
    n_after = after.groupBy(key, *by).agg(F.count(F.lit(1)).alias("n_after"))
    return n_after.join(n_before, key).filter("n_after <> n_before")
