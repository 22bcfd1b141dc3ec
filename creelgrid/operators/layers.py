"""Catch per unit of angler effort (CPUA) by block, and the four map layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import YEAR_RANGES, id_month, is_in, month_label, or_zero, prefixed, ratio, round_even
from ..functions.scalars import stable_sum, sum_or_zero, year_range
from .reshape import fill_no_data, named_first, wide_values
from .spatial import attach_blocks

# Years of the wide layer, the least samples a block needs.
WIDE_YEARS = tuple(range(2004, 2023))
MIN_SAMPLES = 3

TRIP = "TripType_Description_effort"
CATCH = "Common_Name_catch"
METRICS = ("CPUA_All", "CPUA_Kept")


def with_month(table: DataFrame) -> DataFrame:
    return table.withColumn("month", id_month("id", is_prefixed=True))


def effort_grain(table: DataFrame, period: str = "year") -> DataFrame:
    """Angler-days and samples per block, trip type and period.

    A trip has one row per species, so its effort is made distinct first.
    """
    trips = table.select("id", period, "Block", "Vessels", "AnglerDays", TRIP).distinct()
    return trips.groupBy("Block", TRIP, period).agg(
        sum_or_zero("AnglerDays").alias("AnglerDays"),
        F.countDistinct("id").alias("n_samples_effort"),
    )


def catch_grain(table: DataFrame, period: str = "year") -> DataFrame:
    """Catch per block, species, trip type and period; kept and released at two digits.

    Kept is the observed and Released the whole reported catch.
    """
    return table.groupBy("Block", CATCH, TRIP, period).agg(
        stable_sum("Total_Fish_Caught").alias("TotalCatch"),
        round_even(stable_sum("Total_Obs_Fish_Caught"), 2).alias("Kept"),
        round_even(stable_sum("Total_Rep_Fish_Caught"), 2).alias("Released"),
    )


def with_rates(df: DataFrame) -> DataFrame:
    """CPUA at three digits; no catch or no effort gives 0."""
    return df.withColumns(
        {
            "CPUA_All": or_zero(round_even(ratio("TotalCatch", "AnglerDays"), 3)),
            "CPUA_Kept": or_zero(round_even(ratio("Kept", "AnglerDays"), 3)),
        }
    )


def cpua(catch: DataFrame, effort: DataFrame, species: str, period: str = "year") -> DataFrame:
    """Effort with its catch, which may be none, per block, trip type and period.

    ``catch`` is the chosen species' and ``effort`` every species' part of the table.
    """
    joined = effort_grain(effort, period).alias("e").join(
        catch_grain(catch, period).alias("c"),
        (F.col("e.Block") == F.col("c.Block"))
        & (F.col(f"e.{TRIP}") == F.col(f"c.{TRIP}"))
        & F.col(f"e.{period}").eqNullSafe(F.col(f"c.{period}")),
        "left",
    )
    picked = joined.select(
        "e.Block", f"e.{TRIP}", f"e.{period}", "AnglerDays", "n_samples_effort",
        F.coalesce(F.nullif(F.col(CATCH), F.lit("")), F.lit(species)).alias(CATCH),
        "TotalCatch", "Kept", "Released",
    )
    return with_rates(picked)


def cpua_periods(table: DataFrame, species: str, chosen: str = "chosen") -> DataFrame:
    """`cpua` by year and by month of all years, from one scan: column ``period`` says which.

    ``chosen`` flags the rows of the chosen species; all rows count as effort. Rows of a trip and
    effort collapse first, so what the grouping sets multiply has no species any more. A block or
    trip type that is NULL has effort but no catch.
    """
    caught = F.col(chosen)
    measures = {"fish": "Total_Fish_Caught", "seen": "Total_Obs_Fish_Caught", "told": "Total_Rep_Fish_Caught"}
    trip = ["id", "Block", TRIP, "Vessels", "AnglerDays"]
    once = table.groupBy(*trip, "year", "month").agg(
        F.count_if(caught).alias("hits"), *[F.sum(F.when(caught, F.col(c))).alias(name) for name, c in measures.items()]
    )
    sums = [F.sum(c).alias(c) for c in ("hits", *measures)]
    sets = once.groupingSets([[*trip, "year"], [*trip, "month"]], *trip, "year", "month")
    efforts = sets.agg(F.when(F.grouping("month") == 1, "year").otherwise("month").alias("period"), *sums)
    grain = efforts.groupBy("Block", TRIP, "period", "year", "month").agg(
        sum_or_zero("AnglerDays").alias("AnglerDays"), F.countDistinct("id").alias("n_samples_effort"), *sums
    )
    matched = (F.col("hits") > 0) & F.col("Block").isNotNull() & F.col(TRIP).isNotNull()
    catch = {c: F.when(matched, F.round(or_zero(c), 9)) for c in measures}
    picked = grain.select(
        "period", "Block", TRIP, "year", "month", "AnglerDays", "n_samples_effort", F.lit(species).alias(CATCH),
        catch["fish"].alias("TotalCatch"), round_even(catch["seen"], 2).alias("Kept"), round_even(catch["told"], 2).alias("Released"),
    )
    return with_rates(picked)


def of_period(rates: DataFrame, period: str) -> DataFrame:
    """The part of `cpua_periods` that `cpua` gives for ``year`` or ``month``."""
    other = "month" if period == "year" else "year"
    return rates.filter(F.col("period") == period).drop("period", other)


def layer_long(joined: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """A row per block and year with enough samples."""
    enough = joined.filter(F.col("n_samples_effort") >= min_samples)
    renamed = enough.withColumnsRenamed({CATCH: "Catch", TRIP: "Trip", "n_samples_effort": "Samples"})
    return named_first(renamed, "Block", "Catch", "Trip", "Samples")


def over_years(joined: DataFrame, *extra: str) -> DataFrame:
    """Years summed, rounded again and turned into rates again."""
    sums = joined.groupBy("Block", CATCH, TRIP, *extra).agg(
        sum_or_zero("AnglerDays").alias("AnglerDays"),
        stable_sum("TotalCatch").alias("TotalCatch"),
        round_even(stable_sum("Kept"), 2).alias("Kept"),
        round_even(stable_sum("Released"), 2).alias("Released"),
        F.sum("n_samples_effort").alias("Samples"),
    )
    return with_rates(sums)


def all_years(joined: DataFrame, metrics: Sequence[str], min_samples: int) -> DataFrame:
    return (
        over_years(joined)
        .filter(F.col("Samples") >= min_samples)
        .select("Block", F.col(CATCH).alias("Catch"), *metrics, "Samples")
    )


def _keys(joined: DataFrame) -> DataFrame:
    return joined.withColumnsRenamed({CATCH: "Catch", TRIP: "Trip"})


def layer_wide(
    joined: DataFrame, metric: str = "CPUA_All", min_samples: int = MIN_SAMPLES, years: Sequence[int] = WIDE_YEARS
) -> DataFrame:
    """A column per year for one metric; the minimum holds for all years together."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    names = [f"Y{y}" for y in years]
    wide = wide_values(_keys(joined), ["Block", "Catch", "Trip"], prefixed("year", "Y"), {metric: ""}, names)
    totals = all_years(joined, [metric], min_samples)
    return fill_no_data(wide.join(totals, ["Block", "Catch"]))


def layer_grouped(joined: DataFrame, min_samples: int = MIN_SAMPLES, ranges=YEAR_RANGES) -> DataFrame:
    """Columns per year range for all and for kept fish, plus the all-year rates."""
    ranged = over_years(joined.withColumn("year_group", year_range("year", ranges)), "year_group")
    names = [label for label, _, _ in ranges]
    wide = wide_values(
        _keys(ranged), ["Block", "Catch", "Trip"], F.col("year_group"),
        {"CPUA_All": "All", "CPUA_Kept": "Kept"}, names,
    )
    totals = all_years(joined, ["CPUA_Kept", "CPUA_All"], min_samples)
    return fill_no_data(wide.join(totals, ["Block", "Catch"]))


def layer_monthly(joined_by_month: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """A row per block and calendar month, years pooled, with enough samples."""
    long = layer_long(joined_by_month, min_samples).withColumn("time", month_label("month"))
    return named_first(long, "Block", "Catch", "Trip", "Samples", "time")


def present_years(joined: DataFrame, years: Sequence[int] = WIDE_YEARS) -> list[int]:
    """Which of the years occur in the data, in one aggregate row."""
    counts = joined.agg(*[F.count_if(F.col("year") == str(y)).alias(str(y)) for y in years]).first()
    return [y for y in years if counts[str(y)] > 0]


def rate_audit(joined: DataFrame, years: Sequence[int] = WIDE_YEARS, ranges=YEAR_RANGES) -> DataFrame:
    """Rows whose rate is 0 for want of effort, and rows outside the mapped years."""
    listed = is_in("year", [str(y) for y in years])
    return joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("AnglerDays") == 0).alias("zero_effort"),
        F.count_if(~listed).alias("outside_years"),
        F.count_if(year_range("year", ranges).isNull()).alias("outside_ranges"),
    )


def to_layer(result: DataFrame, polygons: DataFrame) -> DataFrame:
    return attach_blocks(result, polygons)
