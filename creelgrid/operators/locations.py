"""Trip locations: codes, screens, coordinates to blocks, merged duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import reasons
from ..functions.scalars import (
    BLOCK_SENTINEL,
    MIN_CODE,
    default_locn,
    is_box,
    is_in,
    joined_box,
    prefixed,
    strip_zeros,
    to_number,
    trip_location_id,
)
from .dedupe import consolidate_blocks, dup_rate, group_sizes
from .rejects import REASON, Keep, Stage, all_rejects, in_plan, split_rejects
from .reshape import SLOT_NAMES, blocks_to_slots, union_by_name, union_strict
from .spatial import locate_points

# The mode of private and rental boats, the year the newer files
# replace, and the limits of a usable coordinate.
BOAT_MODE = 7
REPLACED_YEAR = "2016"
MAX_LAT = 50
MIN_LON = -150
MAX_RANGE = 1

CODES = SLOT_NAMES[:6]
ATTRIBUTES = ("year", "ID_CODE", "MODE_FX", "survey", "ddlat", "ddlong", "HGSIZE", "hgsize2")
STACK_REASON = "stack_reason"


def stack_locations(old_north: DataFrame, old_south: DataFrame, new: DataFrame) -> DataFrame:
    """All regions and years. Old rows of the year the new files cover, and old rows without
    a year, say so in ``stack_reason`` and become rejects; other texts in YEAR stay."""
    year = F.col("YEAR")
    why = F.when(year.isNull(), reasons.LOCATION_NO_YEAR).when(year == REPLACED_YEAR, reasons.LOCATION_REPLACED)
    old = union_strict(old_north, old_south).withColumn(STACK_REASON, why)
    return union_by_name(old, new.withColumnsRenamed({"id_code": "ID_CODE"}))


def location_codes(i8: DataFrame) -> DataFrame:
    """Trip-location id and the six ``block-box`` texts of a raw location row."""

    def block(c):
        stripped = strip_zeros(c)
        return F.when(F.col(c) != BLOCK_SENTINEL, stripped) if c == "block1" else stripped

    pairs = [(block(b), strip_zeros(f"box{b[-1]}{x}")) for b in ("block1", "block2") for x in "abc"]
    stacked = F.col(STACK_REASON) if STACK_REASON in i8.columns else F.lit(None).cast("string")
    return i8.select(
        stacked.alias(STACK_REASON),
        trip_location_id("ID_CODE", default_locn("locn")).alias("id_loc"),
        F.col("YEAR").alias("year"),
        "ID_CODE",
        "MODE_FX",
        "survey",
        to_number("ddlat").alias("ddlat"),
        to_number("ddlong").alias("ddlong"),
        F.col("ddlat").isNotNull().alias("lat_given"),
        "HGSIZE",
        "hgsize2",
        *[joined_box(b, x).alias(name) for (b, x), name in zip(pairs, CODES)],
    )


def without_block():
    """True when not one of the six texts is a code; the longest decides."""
    return F.greatest(*[F.length(c) for c in CODES]) < MIN_CODE


def _wide_range(column: str):
    return F.col(column).isNotNull() & ~F.coalesce(to_number(column) <= MAX_RANGE, F.lit(False))


def screen_locations(coded: DataFrame, keep: Keep = in_plan) -> Stage:
    """All screens on single rows, in one pass.

    Only rows without a block are judged by their coordinates, whose longitude
    is stored positive.
    """
    lat, lon = F.col("ddlat"), -F.col("ddlong")
    boat = F.coalesce(to_number("MODE_FX") == BOAT_MODE, F.lit(False))
    wide = _wide_range("HGSIZE") | _wide_range("hgsize2")
    usable = F.coalesce((lat < MAX_LAT) & (lon > MIN_LON), F.lit(False))
    by_coordinates = [
        (reasons.LOCATION_EMPTY, ~F.col("lat_given")),
        (reasons.LOCATION_RANGE, wide),
        (reasons.LOCATION_BAD_COORDS, (lat > MAX_LAT) | (lon < MIN_LON) | lon.isNull()),
        (reasons.LOCATION_UNUSABLE_COORDS, ~usable),
    ]
    return split_rejects(
        coded,
        [
            *[(r, F.col(STACK_REASON) == r) for r in (reasons.LOCATION_REPLACED, reasons.LOCATION_NO_YEAR)],
            (reasons.MISSING_ID, F.col("id_loc").isNull()),
            (reasons.LOCATION_NOT_BOAT, ~boat),
            (by_coordinates, without_block()),
            (reasons.LOCATION_RANGE, wide),
        ],
        keep,
        "screened_locations",
    )


def locate_rows(screened: DataFrame, polygons: DataFrame, cell=None, keep: Keep = in_plan) -> Stage:
    """One row per location row and block, from its codes or else its coordinates.

    Coordinates are used only where no block is given; their longitude is turned.
    """
    texts = screened.select("id_loc", *ATTRIBUTES, F.explode(F.array(*CODES)).alias("Block"))
    given = texts.filter(is_box("Block"))
    points = (
        screened.filter(without_block())
        .select("id_loc", *ATTRIBUTES)
        .withColumn("ddlong", -F.col("ddlong"))
    )
    layer = polygons.select("NM_INDEX", "rings")
    located = locate_points(points, layer, "ddlong", "ddlat", cell=cell).withColumnRenamed("NM_INDEX", "Block")
    split = split_rejects(located, [(reasons.LOCATION_OFF_MAP, F.col("Block").isNull())], keep, "located_points")
    return Stage(given.unionByName(split.kept), split.rejects.drop("Block"), split.reasons)


def clean_locations(i8: DataFrame, polygons: DataFrame, cell=None, keep: Keep = in_plan) -> Stage:
    """Stacked raw location rows to one row per trip location and block.

    Columns: id_loc, year, ID_CODE, MODE_FX, survey, Block, total_blocks.
    """
    screened = screen_locations(location_codes(i8), keep)
    located = locate_rows(screened.kept, polygons, cell, keep)
    merged = consolidate_blocks(located.kept, "id_loc", ATTRIBUTES)
    kept = merged.kept.select(
        prefixed("id_loc").alias("id_loc"),
        "year",
        prefixed("ID_CODE").alias("ID_CODE"),
        "MODE_FX",
        "survey",
        "Block",
        "total_blocks",
    )
    rejects = all_rejects(screened.rejects.drop("lat_given", STACK_REASON, *CODES), located.rejects, merged.rejects)
    return Stage(kept, rejects, tuple(reasons.LOCATION))


def location_slots(locations: DataFrame) -> DataFrame:
    """The wide form: one row per trip location with numbered block columns."""
    heads = ["year", "ID_CODE", "MODE_FX", "survey", "total_blocks"]
    return blocks_to_slots(locations, "id_loc", heads)


def range_sizes(screened: DataFrame) -> DataFrame:
    """How often each pair of range sizes occurs among boat rows with a place."""
    before = [
        reasons.LOCATION_REPLACED, reasons.LOCATION_NO_YEAR, reasons.MISSING_ID, reasons.LOCATION_NOT_BOAT,
        reasons.LOCATION_EMPTY,
    ]
    return group_sizes(screened.filter(~is_in(REASON, before)), ["HGSIZE", "hgsize2"])


def duplicate_rate(screened: DataFrame, located_points: DataFrame) -> DataFrame:
    """Share of trip locations given more than once, before they are merged."""
    given = screened.filter(F.col(REASON).isNull() & ~without_block()).select("id_loc")
    found = located_points.filter(F.col(REASON).isNull()).select("id_loc")
    return dup_rate(given.unionByName(found), "id_loc")
