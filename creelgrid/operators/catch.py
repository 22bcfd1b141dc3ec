"""Observed and reported catch per trip, block and species.

Catch is summed per trip and species before anything is joined, so that the
joins see one row per trip and species however many rows a trip has. It carries
the blocks of its trip as a list and becomes a row per block only after the last
shuffle. Raw rows are joined only to list the rejected ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import reasons
from ..functions.scalars import (
    default_locn,
    id_date,
    id_month,
    is_in,
    or_zero,
    prefixed,
    ratio,
    sum_or_zero,
    to_number,
    trip_location_id,
)
from .dedupe import alike, drop_ambiguous, extremes, fingerprint
from .joins import flag_known, keyed_join, skew_join
from .party import book_to_leader
from .rejects import Keep, Stage, all_rejects, in_plan, split_rejects
from .species import catch_species

# Disposition codes of released (alive, dead) and kept fish.
ALIVE_CODES = ("1", "2")
DEAD_CODES = ("6",)
KEPT_CODES = ("3", "4", "5", "7")


def catch_rows(raw: DataFrame, *extra: str) -> DataFrame:
    """Ids, year and species code of catch rows plus the columns of one kind."""
    locn = default_locn("locn")
    return raw.select(
        prefixed(trip_location_id("ID_CODE", locn)).alias("id"),
        locn.alias("locn"),
        id_date("ID_CODE").alias("date"),
        id_month("ID_CODE").alias("month"),
        F.col("YEAR").alias("year"),
        F.col("SP_CODE").alias("code_text"),
        to_number("SP_CODE").alias("SP_CODE"),
        *extra,
    )


def usable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("id").isNotNull() & F.col("SP_CODE").isNotNull())


def screen_catch(
    rows: DataFrame, locations: DataFrame, species: DataFrame, keep: Keep = in_plan, name: str = "screened_catch"
) -> Stage:
    """Rows with and without a usable code, a known species and a location."""
    known = flag_known(rows, "SP_CODE", species, "SP_CODE", "__species")
    placed = flag_known(known, "id", locations, "id_loc", "__placed")
    stage = split_rejects(
        placed,
        [
            (reasons.CATCH_BAD_CODE, F.col("SP_CODE").isNull()),
            (reasons.MISSING_ID, F.col("id").isNull()),
            (reasons.CATCH_NO_SPECIES, ~F.col("__species")),
            (reasons.NO_LOCATION, ~F.col("__placed")),
        ],
        keep,
        name,
    )
    flags = ("__species", "__placed")
    return Stage(stage.kept.drop(*flags), stage.rejects.drop(*flags), stage.reasons)


def location_targets(locations: DataFrame, leaders: DataFrame) -> DataFrame:
    """The blocks of each trip location, as a list, with the id its catch is booked under.

    A location has one trip and one number of blocks. A trip listed several times under one
    leader has its catch counted as often; the listings become a factor here instead of copies
    of every catch row. Only trips with a leader are joined with it; all meet by location.
    """
    heads = locations.groupBy("id_loc").agg(
        F.min("ID_CODE").alias("ID_CODE"), F.min("total_blocks").alias("total_blocks"), F.collect_list(F.struct("Block")).alias("blocks")
    )
    listed = leaders.groupBy("ID_CODE", "LEADER_ID").agg(F.count(F.lit(1)).alias("listings"))
    booked = skew_join(locations.select("id_loc", "ID_CODE").distinct(), listed, ["ID_CODE"]).drop("ID_CODE")
    joined = keyed_join(heads, booked, ["id_loc"], "left")
    return joined.withColumn("listings", F.coalesce("listings", F.lit(1)))


def with_blocks(targets: DataFrame) -> DataFrame:
    """Targets that differ only in ``Block`` as one row with the list of their blocks, at most those of the map."""
    heads = [c for c in targets.columns if c != "Block"]
    return targets.groupBy(*heads).agg(F.collect_list(F.struct("Block")).alias("blocks"))


def over_blocks(placed: DataFrame, measures: list[str]) -> DataFrame:
    """A row for each block of the list, with each measure divided by the blocks of the trip location."""
    rest = [c for c in placed.columns if c != "blocks"]
    spread = placed.select(*rest, F.inline("blocks"))
    return spread.withColumns({m: F.col(m) / F.col("total_blocks") for m in measures})


def spread_over_blocks(catch: DataFrame, targets: DataFrame, measures: list[str]) -> DataFrame:
    """Each measure divided by the blocks of the trip location, one row per block."""
    return over_blocks(skew_join(catch, with_blocks(targets), [("id", "id_loc")]), measures)


def with_names(placed: DataFrame, species: DataFrame) -> DataFrame:
    """Names and trip type of the species, and how many names its code has.

    Rows move by a hash of the code alone, ``code_hash``, which the sums over blocks keep among
    their keys: they need no shuffle after the one of this join, which a common species splits.
    The codes themselves are compared as an order, since Spark moves rows by all equal keys.
    """
    names = catch_species(species).withColumn("names", F.count(F.lit(1)).over(Window.partitionBy("SP_CODE")))
    names = names.withColumnRenamed("SP_CODE", "__code").withColumn("__hash", F.xxhash64("__code"))
    coded = placed.withColumn("code_hash", F.xxhash64("SP_CODE"))
    same = (F.col("SP_CODE") >= F.col("__code")) & (F.col("SP_CODE") <= F.col("__code"))
    return coded.join(names, (F.col("code_hash") == F.col("__hash")) & same).drop("__hash", "__code")


def count_listings(placed: DataFrame, measures: list[str]) -> DataFrame:
    return placed.withColumns({m: F.col(m) * F.col("listings") for m in measures}).drop("listings")


# observed catch


def observed_rows(i3: DataFrame) -> DataFrame:
    """One row per weighed fish; the inspected count repeats on each."""
    return catch_rows(i3, "MODE_F", "DISP3", "WGT", "FSHINSP").withColumns(
        {"fish": or_zero(to_number("FSHINSP")), "weight": to_number("WGT")}
    )


def collapse_weighed(rows: DataFrame) -> DataFrame:
    """Row count, fish and weights per trip location, year and species."""
    return rows.groupBy("id", "locn", "year", "SP_CODE").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("fish").alias("fish"),
        F.sum("weight").alias("weight"),
        F.count("weight").alias("weighed"),
    )


def unrepeat_weights(collapsed: DataFrame) -> DataFrame:
    """Undo the repetition of the count on every weighed fish of (id, species)."""
    same = Window.partitionBy("id", "SP_CODE")
    return collapsed.withColumn("fish", F.col("fish") / F.sum("rows").over(same))


def aggregate_observed(placed: DataFrame) -> DataFrame:
    keys = ["id", "ID_CODE", "locn", "year", "Block", "SP_CODE", "Common_Name", "TripType_Description"]
    sums = placed.groupBy(*keys, "code_hash").agg(
        sum_or_zero("fish").alias("Total_Obs_Fish_Caught"),
        F.sum("weight").alias("__weight"),
        F.sum("weighed").alias("Ob_Weighed_Fish"),
    )
    return sums.select(
        *keys,
        "Total_Obs_Fish_Caught",
        ratio("__weight", "Ob_Weighed_Fish").alias("Ob_AvKWgt"),
        "Ob_Weighed_Fish",
    )


def observed_catch(
    i3: DataFrame, locations: DataFrame, species: DataFrame, leaders: DataFrame, keep: Keep = in_plan
) -> Stage:
    """Sampler-observed catch per trip location, block and species.

    One shuffle by id, after the rows of a trip have collapsed to one per species,
    serves both the window of `unrepeat_weights` and the join with the blocks. Under a
    code with several names every fish was counted once for each, so it is divided by them.
    """
    rows = keep(observed_rows(i3), "observed_rows")
    caught = unrepeat_weights(collapse_weighed(usable(rows)).repartition("id"))
    placed = keyed_join(caught, location_targets(locations, leaders), [("id", "id_loc")])
    named = with_names(book_to_leader(placed.drop("rows")), species).withColumn("fish", F.col("fish") / F.col("names"))
    spread = over_blocks(named.drop("names"), ["fish"])
    return Stage(
        aggregate_observed(count_listings(spread, ["fish", "weight", "weighed"])),
        lambda: screen_catch(rows, locations, species, keep, "screened_observed").rejects,
        tuple(reasons.OBSERVED),
    )


# reported catch


def reported_rows(i2: DataFrame) -> DataFrame:
    """Angler-reported rows; exact copies collapse."""
    return catch_rows(i2.distinct(), "DISPO", "NUM_FISH").withColumn("fish", or_zero(to_number("NUM_FISH")))


def split_disposition(rows: DataFrame) -> DataFrame:
    """Fish by disposition; other codes count in none."""

    def part(codes):
        return F.when(is_in(_plain("DISPO"), codes), F.col("fish")).otherwise(0.0)

    return rows.withColumns({"alive": part(ALIVE_CODES), "dead": part(DEAD_CODES), "kept": part(KEPT_CODES)})


def _plain(column: str):
    return F.regexp_replace(column, r"\.0*$", "")


def collapse_reported(rows: DataFrame) -> DataFrame:
    """Fish by disposition per trip location, year and species."""
    return rows.groupBy("id", "locn", "year", "SP_CODE").agg(*[F.sum(c).alias(c) for c in ("alive", "dead", "kept")])


def aggregate_reported(placed: DataFrame) -> DataFrame:
    keys = ["id", "ID_CODE", "year", "Block", "SP_CODE", "Common_Name", "TripType_Description"]
    sums = placed.groupBy(*keys, "code_hash").agg(
        sum_or_zero("alive").alias("Rep_Released_Alive"),
        sum_or_zero("dead").alias("Rep_Released_Dead"),
        sum_or_zero("kept").alias("Rep_Kept"),
    )
    alive, dead, kept = F.col("Rep_Released_Alive"), F.col("Rep_Released_Dead"), F.col("Rep_Kept")
    return sums.drop("code_hash").withColumns({"Total_Rep_Fish_Caught": alive + kept + dead, "Rep_Released": alive + dead})


def unambiguous(i2: DataFrame) -> DataFrame:
    """Usable rows whose (id, species, disposition) no other row has; exact copies collapse.

    Rows of a key, location number and year collapse to one before they move, which says
    whether they all are copies; the window sees those of a trip.
    """
    marked = i2.withColumn("__mark", fingerprint(*i2.columns))
    rows = catch_rows(marked, "DISPO", "__mark", or_zero(to_number("NUM_FISH")).alias("fish"))
    alone = usable(rows).groupBy("id", "locn", "year", "SP_CODE", "DISPO").agg(F.max("fish").alias("fish"), *extremes("__mark"))
    different = alone.withColumn("__rows", F.when(alike(), 1).otherwise(2)).drop("__least", "__most").repartition("id")
    same = Window.partitionBy("id", "SP_CODE", "DISPO")
    return different.withColumn("__rows", F.sum("__rows").over(same)).filter("__rows = 1").drop("__rows")


def reported_catch(
    i2: DataFrame, locations: DataFrame, species: DataFrame, leaders: DataFrame, keep: Keep = in_plan
) -> Stage:
    """Angler-reported catch per trip location, block and species.

    A repeated (id, species, disposition) has no copy that can be trusted, so all
    of them go, and with them a code of several names. The rule needs no location and
    therefore runs before the join; what is left is at most one row per species and
    disposition of a trip, and one shuffle by id serves the rule, the sums and the join
    with the blocks.
    """
    summed = collapse_reported(split_disposition(unambiguous(i2)))
    placed = keyed_join(summed, location_targets(locations, leaders), [("id", "id_loc")])
    named = with_names(book_to_leader(placed).drop("locn"), species).filter("names = 1").drop("names")
    spread = over_blocks(named, ["alive", "dead", "kept"])

    def rejects() -> DataFrame:
        rows = keep(reported_rows(i2), "reported_rows")
        screened = screen_catch(rows, locations, species, keep, "screened_reported")
        listed = keyed_join(screened.kept, catch_species(species).drop("TripType_Description"), ["SP_CODE"])
        copies = drop_ambiguous(listed, ["id", "SP_CODE", "DISPO"], reasons.CATCH_AMBIGUOUS).rejects
        return all_rejects(screened.rejects, copies)

    return Stage(aggregate_reported(count_listings(spread, ["alive", "dead", "kept"])), rejects, tuple(reasons.REPORTED))
