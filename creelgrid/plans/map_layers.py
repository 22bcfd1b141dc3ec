"""The four CPUA map layers of one species or group and trip type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import YEAR_RANGES
from ..operators import layers
from ..operators.species import check_species, flag_species, select_trip
from ..session import configure, stage_table
from ..sources.writers import layer_name, write_layer, write_table


@dataclass(frozen=True)
class Choice:
    """What to map. ``years`` are the columns of the wide layer, as far as they occur, and
    ``ranges`` (label, first, last year) those of the grouped one; the audit counts rows outside."""

    species: str
    trip: str = "All"
    min_samples: int = layers.MIN_SAMPLES
    metric: str = "CPUA_All"
    years: tuple[int, ...] = layers.WIDE_YEARS
    ranges: tuple[tuple[str, int, int], ...] = YEAR_RANGES


def map_layers(
    spark: SparkSession,
    table: DataFrame,
    polygons: DataFrame,
    choice: Choice,
    groups: DataFrame | None = None,
    out: str | None = None,
) -> dict[str, DataFrame]:
    """Long, wide, grouped and monthly layer; written under ``out`` if given.

    One scan of the table gives the yearly and the monthly rates. They have one row
    per block and period, whatever the number of trips, and are a stage table, which
    `drop_stages` removes when the layers are no longer needed. The yearly ones, which
    feed three layers, are written under ``out`` too.
    """
    configure(spark)
    check_species(table, choice.species, groups)
    flagged = select_trip(flag_species(layers.with_month(table), choice.species, groups), choice.trip)
    rates = stage_table(layers.cpua_periods(flagged, choice.species), "cpua")
    yearly, monthly = (layers.of_period(rates, p) for p in ("year", "month"))
    name = layer_name(choice.species, choice.trip, choice.min_samples, "cpua_year")
    yearly = write_table(yearly, f"{out}/{name}") if out else yearly
    results = {
        "long": layers.layer_long(yearly, choice.min_samples),
        choice.metric: layers.layer_wide(
            yearly, choice.metric, choice.min_samples, layers.present_years(yearly, choice.years)
        ),
        "GROUPS": layers.layer_grouped(yearly, choice.min_samples, choice.ranges),
        "monthly": layers.layer_monthly(monthly, choice.min_samples),
    }
    placed = {kind: layers.to_layer(result, polygons) for kind, result in results.items()}
    if out:
        for kind, layer in placed.items():
            name = layer_name(choice.species, choice.trip, choice.min_samples, kind)
            write_layer(layer, f"{out}/{name}")
        audit = layer_name(choice.species, choice.trip, choice.min_samples, "audit")
        write_table(layers.rate_audit(yearly, choice.years, choice.ranges), f"{out}/{audit}")
    return placed
