"""Species lookup, species groups, primary target, choice of species."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, to_number
from .joins import flag_known, keyed_join, rows_in

# A lookup name that shares its code with another one, and the trip
# type whose trips are credited to the second target.
DROPPED_NAME = "bivalve class"
SECOND_TARGET_TYPE = "Invertebrates"


def clean_species(raw: DataFrame) -> DataFrame:
    """Trimmed lookup with a numeric code, without the name whose code is a duplicate."""
    tidy = raw.select(
        to_number(F.col("PSMFC_Code").cast("string")).alias("SP_CODE"),
        blank_to_null("PSMFC_Code").alias("code_text"),
        blank_to_null("ALPHA5").alias("Alpha"),
        blank_to_null("Common_Name").alias("Common_Name"),
        blank_to_null("TripType_Description").alias("TripType_Description"),
    )
    return tidy.filter(F.col("Common_Name") != DROPPED_NAME)


def catch_species(species: DataFrame) -> DataFrame:
    return species.select("SP_CODE", "Common_Name", "TripType_Description")


def target_species(species: DataFrame) -> DataFrame:
    """The lookup by text code, as trip targets are matched."""
    return species.filter(F.col("code_text").isNotNull()).select(
        "code_text", "Common_Name", "TripType_Description"
    )


def primary_target(i1: DataFrame, species: DataFrame) -> DataFrame:
    """First target, unless it is an invertebrate and a second one is given."""
    types = target_species(species).select("code_text", F.col("TripType_Description").alias("__type"))
    joined = keyed_join(i1, types, [("prim1", "code_text")], "left")
    second = (F.col("__type") == SECOND_TARGET_TYPE) & F.col("prim2").isNotNull()
    return joined.withColumn("primary", F.when(second, F.col("prim2")).otherwise(F.col("prim1"))).drop("__type")


def group_names(groups: DataFrame) -> list[str]:
    """Group names: every column but the first."""
    return groups.columns[1:]


def group_members(groups: DataFrame) -> DataFrame:
    """The 0/1 matrix as (species, group) rows."""
    first = groups.columns[0]
    flags = groups.select(
        F.col(first).alias("Common_Name_catch"),
        *[F.col(f"`{c}`").cast("int").alias(c) for c in group_names(groups)],
    )
    long = flags.unpivot(["Common_Name_catch"], group_names(groups), "group", "flag")
    return long.filter("flag = 1").select("Common_Name_catch", "group")


def check_species(table: DataFrame, species: str, groups: DataFrame | None) -> None:
    if groups is not None and species in group_names(groups):
        return
    if table.filter(F.col("Common_Name_catch") == species).isEmpty():
        raise ValueError(f"{species!r} is neither a species of the data nor a species group")


def select_species(table: DataFrame, species: str, groups: DataFrame | None = None) -> DataFrame:
    """Rows of one species, or of all members of a group under the group's name."""
    if groups is None or species not in group_names(groups):
        return table.filter(F.col("Common_Name_catch") == species)
    members = group_members(groups).filter(F.col("group") == species)
    return rows_in(table, "Common_Name_catch", members).withColumn("Common_Name_catch", F.lit(species))


def flag_species(table: DataFrame, species: str, groups: DataFrame | None = None, flag: str = "chosen") -> DataFrame:
    """Every row, flagged where `select_species` would keep it."""
    if groups is None or species not in group_names(groups):
        return table.withColumn(flag, F.coalesce(F.col("Common_Name_catch") == species, F.lit(False)))
    members = group_members(groups).filter(F.col("group") == species)
    return flag_known(table, "Common_Name_catch", members, "Common_Name_catch", flag)


def select_trip(table: DataFrame, trip: str) -> DataFrame:
    """Rows of one trip type; ``All`` keeps every row under the label ``All``."""
    column = "TripType_Description_effort"
    if trip.lower() == "all":
        return table.withColumn(column, F.lit("All"))
    return table.filter(F.col(column) == trip)
