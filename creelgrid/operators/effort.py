"""Fishing effort per trip, block and trip type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import reasons
from ..functions.scalars import or_zero, prefixed, sum_or_zero, to_number
from .dedupe import drop_ambiguous, same_blocks
from .joins import keyed_join, skew_join
from .party import rollup_parties
from .rejects import REASON, Keep, Stage, all_rejects, in_plan
from .reshape import union_by_name
from .species import primary_target, target_species

TEXT = ("prim1", "prim2", "LEADER", "PRT_CODE", "FIRST", "survey")
ROW = ("id", "year", *TEXT, "CNTRBTRS", "DAYSF", "primary", "Common_Name", "TripType_Description")


def stack_effort(old: DataFrame, new: DataFrame) -> DataFrame:
    return union_by_name(old, new.withColumnsRenamed({"daysf": "DAYSF"}))


def effort_rows(i1: DataFrame) -> DataFrame:
    """The columns effort needs, ids unprefixed."""
    return i1.select(F.col("ID_CODE").alias("id"), F.col("YEAR").alias("year"), *TEXT, "CNTRBTRS", "DAYSF")


def normalise_effort(rows: DataFrame) -> DataFrame:
    """Missing days and contributors are 0; no days but contributors means one day."""

    def number(c):
        return F.when(F.col(c).isNull(), 0.0).otherwise(to_number(c))

    numeric = rows.withColumns({"CNTRBTRS": number("CNTRBTRS"), "DAYSF": number("DAYSF")})
    one_day = (F.col("DAYSF") == 0) & (F.col("CNTRBTRS") > 0)
    return numeric.withColumn("DAYSF", F.when(one_day, 1.0).otherwise(F.col("DAYSF")))


def trip_blocks(locations: DataFrame) -> DataFrame:
    """(ID_CODE, Block) over all locations of a trip; effort has no location number."""
    return locations.select("ID_CODE", "Block").distinct()


def trip_block_sets(locations: DataFrame) -> DataFrame:
    """One row per trip and different set of blocks among its locations."""
    sets = same_blocks(locations, "id_loc")
    heads = locations.select("id_loc", "ID_CODE").distinct()
    return heads.join(sets, "id_loc").select("ID_CODE", "blocks").distinct()


def effort_by_block(rows: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per effort row and block of its trip, measures undivided."""
    placed = keyed_join(rows.filter("CNTRBTRS > 0").distinct(), trip_blocks(locations), [("id", "ID_CODE")])
    return placed.withColumn("Vessels", F.lit(1.0))


def aggregate_effort(by_block: DataFrame) -> DataFrame:
    """Sums per trip, year, block and target; angler-days is the product of the sums."""
    sums = by_block.groupBy("id", "year", "Block", "Common_Name", "TripType_Description").agg(
        sum_or_zero("DAYSF").alias("Days"),
        sum_or_zero("CNTRBTRS").alias("Cntrbs"),
        sum_or_zero("Vessels").alias("Vessels"),
    )
    return sums.withColumn("AnglerDays", F.col("Cntrbs") * F.col("Days")).withColumnRenamed("id", "id_noloc")


def effort(i1: DataFrame, locations: DataFrame, species: DataFrame, keep: Keep = in_plan) -> Stage:
    """Raw effort rows to (id_noloc, year, Block, target) rows.

    All rows of a trip share the blocks of the trip, so whether a (trip, block,
    trip type, year) is ambiguous does not depend on the block: ambiguity is
    decided per (trip, trip type, year) before rows multiply by blocks. What is
    left is one row per result row, so `aggregate_effort` would sum single rows
    and its shuffle is spared.
    """
    rows = keep(primary_target(normalise_effort(effort_rows(i1)), species), "effort_targets")
    parties = rollup_parties(rows)
    targets = target_species(species)
    named = keep(
        keyed_join(parties.kept, targets, [("primary", "code_text")], "left").withColumn("id", prefixed("id")),
        "effort_named",
    )
    known = named.filter(F.col("Common_Name").isNotNull())
    keys = ["id", "TripType_Description", "year"]
    positive = known.filter("CNTRBTRS > 0").select(*ROW).distinct()
    once = drop_ambiguous(positive, keys, reasons.EFFORT_AMBIGUOUS).kept
    by_block = keyed_join(
        once.select("id", "year", "Common_Name", "TripType_Description", "DAYSF", "CNTRBTRS"),
        trip_blocks(locations),
        [("id", "ID_CODE")],
    )
    kept = by_block.select(
        F.col("id").alias("id_noloc"),
        "year",
        "Block",
        "Common_Name",
        "TripType_Description",
        or_zero("DAYSF").alias("Days"),
        F.col("CNTRBTRS").alias("Cntrbs"),
        F.lit(1.0).alias("Vessels"),
        (F.col("CNTRBTRS") * or_zero("DAYSF")).alias("AnglerDays"),
    )
    return Stage(
        kept, lambda: all_rejects(parties.rejects, *effort_rejects(named, known, positive, locations, keys)), tuple(reasons.EFFORT)
    )


def effort_rejects(
    named: DataFrame, known: DataFrame, positive: DataFrame, locations: DataFrame, keys: list[str]
) -> list[DataFrame]:
    """Rows without a species, a location or contributors, and ambiguous rows.

    A row without contributors is listed once per different set of blocks of its trip.
    """
    trips = locations.select("ID_CODE").distinct()
    homeless = skew_join(known, trips, [("id", "ID_CODE")], "left_anti")
    idle = skew_join(
        known.filter(~F.coalesce(F.col("CNTRBTRS") > 0, F.lit(False))),
        trip_block_sets(locations),
        [("id", "ID_CODE")],
    ).drop("blocks")
    why = F.when(F.col("CNTRBTRS") == 0, reasons.EFFORT_NO_CONTRIBUTORS).otherwise(reasons.EFFORT_BAD_CONTRIBUTORS)
    placed = skew_join(positive, trips, [("id", "ID_CODE")], "left_semi")
    return [
        named.filter(F.col("Common_Name").isNull()).withColumn(REASON, F.lit(reasons.EFFORT_NO_SPECIES)),
        homeless.withColumn(REASON, F.lit(reasons.NO_LOCATION)),
        idle.withColumn(REASON, why),
        drop_ambiguous(placed, keys, reasons.EFFORT_AMBIGUOUS).rejects,
    ]
