"""Boat parties on the older angler forms: leaders, followers and their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import reasons
from ..functions.scalars import prefixed, to_number
from .joins import skew_join
from .rejects import REASON, Stage, all_rejects

# Fixed value: angler forms carry no survey and end with this year.
LAST_FORM_YEAR = 2013


def is_angler_form():
    return (to_number("year") <= LAST_FORM_YEAR) & F.col("survey").isNull()


def _linked():
    return F.coalesce("LEADER", "PRT_CODE").isNotNull()


def party_role(i1: DataFrame) -> DataFrame:
    """``role``: other, leader, follower or unplaced; ``LEADER_ID`` of followers."""
    form = F.coalesce(is_angler_form(), F.lit(False))
    return i1.withColumns(
        {
            "role": F.when(~form, "other")
            .when(_linked(), "follower")
            .when(to_number("FIRST") == 1, "leader")
            .otherwise("unplaced"),
            "LEADER_ID": F.coalesce("LEADER", "PRT_CODE"),
        }
    )


def rollup_parties(i1: DataFrame) -> Stage:
    """Add the followers' contributors to their leader and drop the followers.

    Rows outside the angler forms pass unchanged. Followers are summed per leader
    before the join, so a leader with very many followers is one row in it.
    """
    roled = party_role(i1)
    followers = roled.filter("role = 'follower'")
    sums = followers.groupBy("LEADER_ID").agg(F.sum("CNTRBTRS").alias("__led"))
    kept = add_led(roled.filter("role in ('other', 'leader')").drop("LEADER_ID"), sums)
    leaders = roled.filter("role = 'leader'").select("id").distinct()
    alone = skew_join(followers, leaders, [("LEADER_ID", "id")], "left_anti")
    rejects = all_rejects(
        roled.filter("role = 'unplaced'").withColumn(REASON, F.lit(reasons.EFFORT_UNPLACED)),
        alone.withColumn(REASON, F.lit(reasons.EFFORT_FOLLOWER_ALONE)),
    )
    return Stage(
        kept.drop("role"),
        rejects.drop("role", "LEADER_ID"),
        (reasons.EFFORT_UNPLACED, reasons.EFFORT_FOLLOWER_ALONE),
    )


def add_led(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """Leaders with their own plus the followers' contributors, NULLs skipped; other rows as they are."""
    own = sums.withColumn("__role", F.lit("leader"))
    joined = skew_join(rows, own, [("role", "__role"), ("id", "LEADER_ID")], "left")
    total = F.coalesce("CNTRBTRS", F.lit(0.0)) + F.coalesce("__led", F.lit(0.0))
    return joined.withColumn("CNTRBTRS", F.when(F.col("role") == "leader", total).otherwise(F.col("CNTRBTRS"))).drop("__led")


def leader_map(i1: DataFrame) -> DataFrame:
    """(ID_CODE, LEADER_ID) of the angler forms, with the id prefix; unlinked rows lead themselves."""
    forms = i1.filter(is_angler_form())
    leader = F.coalesce("LEADER", "PRT_CODE", "id")
    return forms.select(prefixed("id").alias("ID_CODE"), prefixed(leader).alias("LEADER_ID"))


def book_to_leader(catch: DataFrame) -> DataFrame:
    """Use the ids of ``LEADER_ID`` where the trip has one."""
    return catch.withColumns(
        {
            "ID_CODE": F.coalesce("LEADER_ID", "ID_CODE"),
            "id": F.coalesce(F.concat("LEADER_ID", "locn"), F.col("id")),
        }
    ).drop("LEADER_ID")


def remap_to_leader(catch: DataFrame, leaders: DataFrame) -> DataFrame:
    """Give catch of a party member the id of its leader.

    A member with several leaders fans out, as `dup_audit` on the map shows.
    """
    return book_to_leader(skew_join(catch, leaders, ["ID_CODE"], "left"))
