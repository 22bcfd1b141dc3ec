"""Observed catch, reported catch and effort as one table per trip, block and species."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import reasons
from ..functions.scalars import or_zero
from ..session import stage_table
from .dedupe import group_sizes
from .joins import full_join, merge_unique
from .rejects import REASON, Keep, Stage, in_plan

# The published columns.
MEASURES = (
    "Ob_Weighed_Fish", "Ob_AvKWgt", "Total_Obs_Fish_Caught", "Rep_Released_Dead", "Rep_Kept",
    "Rep_Released_Alive", "Total_Rep_Fish_Caught", "Days", "Cntrbs", "Vessels", "AnglerDays",
)
NAMES = (
    "Common_Name_catch", "Common_Name_effort", "TripType_Description_catch", "TripType_Description_effort",
)
CATCH_KEYS = ["id", "ID_CODE", "SP_CODE", "Block", "Common_Name", "TripType_Description", "year"]


def all_catch(observed: DataFrame, reported: DataFrame) -> DataFrame:
    """Observed and reported catch side by side; both carry the trip type of their species."""
    return merge_unique(observed.drop("locn"), reported, CATCH_KEYS, near=("ID_CODE", "SP_CODE"))


def with_effort(catch: DataFrame, effort: DataFrame) -> DataFrame:
    """Full join of catch and effort on trip, block and year; only a year can be NULL.

    Effort has a row per trip type, block and year of a trip; catch may be much more of one trip, which is split.
    """
    joined = full_join(
        catch, effort, [("ID_CODE", "id_noloc"), "Block", "year"], suffixes=("_catch", "_effort"), null_safe=["year"], split_right=False,
        together="ID_CODE",
    )
    return joined.withColumn("id", F.coalesce("id", "ID_CODE"))


def without_effort():
    return F.col("Common_Name_catch").isNotNull() & F.col("Common_Name_effort").isNull()


def publish(joined: DataFrame) -> DataFrame:
    """The published columns, missing measures as 0, and the total catch."""
    table = joined.select("id", "year", "Block", "SP_CODE", *NAMES, *MEASURES)
    filled = table.withColumns({m: or_zero(F.col(m).cast("double")) for m in MEASURES})
    total = F.col("Total_Obs_Fish_Caught") + F.col("Total_Rep_Fish_Caught")
    return filled.withColumn("Total_Fish_Caught", total)


def without_catch():
    return F.col("Common_Name_catch").isNull() & F.col("Common_Name_effort").isNotNull()


def effort_without_catch(joined: DataFrame) -> DataFrame:
    """Effort that no catch belongs to: used, but worth a look."""
    return joined.filter(without_catch()).select("id", "year", "Block", "Common_Name_effort", "TripType_Description_effort", "AnglerDays")


def assemble(observed: DataFrame, reported: DataFrame, effort: DataFrame, keep: Keep = in_plan) -> Stage:
    """``all_by_id`` and the catch that has no effort.

    Both sides are filters of one full join. All inputs are already one row per
    key, so no join key repeats beyond the species and trip types of one trip. The
    catch, which the join reads twice, is a written table.
    """
    catch = all_catch(observed, reported)
    catch = stage_table(catch, "catch") if keep is in_plan else keep(catch, "catch")
    joined = keep(with_effort(catch, effort), "assembled")
    rejects = joined.filter(without_effort()).withColumn(REASON, F.lit(reasons.CATCH_NO_EFFORT))
    return Stage(publish(joined.filter(~without_effort())), rejects, tuple(reasons.OUTPUT))


def combos(joined: DataFrame) -> DataFrame:
    """How often catch and effort names and trip types meet, most frequent first."""
    return group_sizes(joined, NAMES).orderBy(F.desc("n"), *[F.asc_nulls_last(c) for c in NAMES])
