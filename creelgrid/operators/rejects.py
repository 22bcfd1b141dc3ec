"""Screens that split rows into kept and rejected, and the counts about them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "Reason"

# What to do with a frame that several outputs read: leave it in the plan, or
# write it once and go on from the table.
Keep = Callable[[DataFrame, str], DataFrame]


def in_plan(df: DataFrame, name: str) -> DataFrame:
    return df


@dataclass(frozen=True)
class Stage:
    """Result of a step: the rows that go on, the rows that do not, and why.

    Rejects that write tables of their own are given as a function, called when they are first asked for.
    """

    kept: DataFrame
    listed: DataFrame | Callable[[], DataFrame]
    reasons: tuple[str, ...] = ()

    @cached_property
    def rejects(self) -> DataFrame:
        return self.listed() if callable(self.listed) else self.listed

    def summary(self) -> DataFrame:
        return reject_summary(self.rejects, self.reasons)


def _reason(rules: Sequence[tuple]) -> Column:
    out = F.lit(None).cast("string")
    for outcome, predicate in reversed(list(rules)):
        value = F.lit(outcome) if isinstance(outcome, str) else _reason(outcome)
        out = F.when(F.coalesce(predicate, F.lit(False)), value).otherwise(out)
    return out


def _texts(rules: Sequence[tuple]) -> list[str]:
    out: list[str] = []
    for outcome, _ in rules:
        for text in [outcome] if isinstance(outcome, str) else _texts(outcome):
            if text not in out:
                out.append(text)
    return out


def tag_rejects(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Add the reason of the first rule that holds; NULL predicates do not hold.

    A rule is (reason, predicate) or (further rules, predicate); the latter
    evaluates a costly predicate once for all the rules under it.
    """
    return df.withColumn(REASON, _reason(rules))


def split_rejects(df: DataFrame, rules: Sequence[tuple], keep: Keep = in_plan, name: str = "screened") -> Stage:
    """One pass over the rows; both sides are filters of the same tagged frame."""
    tagged = keep(tag_rejects(df, rules), name)
    return Stage(
        tagged.filter(F.col(REASON).isNull()).drop(REASON),
        tagged.filter(F.col(REASON).isNotNull()),
        tuple(_texts(rules)),
    )


def all_rejects(*frames: DataFrame) -> DataFrame:
    """Rejected rows of several screens under one schema."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def reject_summary(rejects: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """(Reason, Count) with a row for every known reason, 0 where none was rejected."""
    counts = F.array(*[
        F.struct(F.lit(r).alias(REASON), F.count_if(F.col(REASON) == r).alias("Count")) for r in reasons
    ])
    return rejects.agg(counts.alias("c")).select(F.inline("c"))


def by_year_audit(rejects: DataFrame, *extra: str, year: str = "year") -> DataFrame:
    return rejects.groupBy(REASON, year, *extra).agg(F.count(F.lit(1)).alias("n"))


def reconcile(before: DataFrame, *parts: DataFrame) -> DataFrame:
    """Row conservation: rows before, rows in all parts, and whether they agree."""
    sides = before.select(F.lit(0).alias("part"))
    for part in parts:
        sides = sides.unionAll(part.select(F.lit(1).alias("part")))
    return sides.agg(
        F.count_if(F.col("part") == 0).alias("rows_before"),
        F.count_if(F.col("part") == 1).alias("rows_after"),
    ).withColumn("balanced", F.col("rows_before") == F.col("rows_after"))
