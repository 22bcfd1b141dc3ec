"""From raw survey tables to ``all_by_id`` with all audits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reasons
from ..operators.assemble import assemble, combos, effort_without_catch
from ..operators.catch import observed_catch, reported_catch
from ..operators.dedupe import dup_audit, group_sizes
from ..operators.effort import effort, effort_rows, stack_effort
from ..operators.joins import join_audit, skew_join
from ..operators.locations import clean_locations, duplicate_rate, location_slots, range_sizes, stack_locations
from ..operators.outliers import observed_rate_outliers, reported_rate_outliers, weight_outliers
from ..operators.party import leader_map
from ..operators.rejects import REASON, Stage, by_year_audit, reconcile
from ..operators.reshape import schema_difference, union_by_name
from ..operators.spatial import rows_off_map, unmatched_blocks
from ..session import configure
from ..sources.writers import write_table


@dataclass(frozen=True)
class Survey:
    """The raw tables as `read_raw` or `ingest` give them, and the lookups."""

    i1_old: DataFrame
    i1_new: DataFrame
    i2_old: DataFrame
    i2_new: DataFrame
    i3_old: DataFrame
    i3_new: DataFrame
    i8_old_north: DataFrame
    i8_old_south: DataFrame
    i8_new: DataFrame
    species: DataFrame
    polygons: DataFrame


def schema_differences(spark: SparkSession, survey: Survey) -> DataFrame:
    """(kind, column, only_in): columns that only the old or only the new files of a kind have."""
    pairs = {
        "i1": (survey.i1_old, survey.i1_new), "i2": (survey.i2_old, survey.i2_new),
        "i3": (survey.i3_old, survey.i3_new), "i8": (survey.i8_old_north, survey.i8_new),
    }
    rows = []
    for kind, (old, new) in pairs.items():
        for side, columns in zip(("old", "new"), schema_difference(old, new)):
            rows += [(kind, c, side) for c in columns]
    return spark.createDataFrame(rows, "kind string, column string, only_in string")


def rebuild(spark: SparkSession, survey: Survey, out: str) -> dict[str, DataFrame]:
    """Write every stage, its rejects and its audits under ``out``.

    ``out`` is a folder all executors reach. Every stage is a written table: the
    next stage scans only the columns it needs, and a lost executor costs one
    stage, not the run.
    """
    configure(spark)
    tables: dict[str, DataFrame] = {}

    def keep(df: DataFrame, name: str, partition_by=()) -> DataFrame:
        tables[name] = write_table(df, f"{out}/{name}", partition_by=partition_by)
        return tables[name]

    def finish(stage: Stage, name: str, partition_by=(), by=()) -> DataFrame:
        kept = keep(stage.kept, name, partition_by)
        rejects = keep(stage.rejects, f"{name}_notused", [REASON])
        keep(Stage(kept, rejects, stage.reasons).summary(), f"{name}_notused_summary")
        keep(by_year_audit(rejects, *by), f"{name}_notused_by_year")
        return kept

    def conserve(name: str, before: DataFrame, *parts: DataFrame) -> None:
        keep(reconcile(before, *parts), f"{name}_reconciled")

    keep(schema_differences(spark, survey), "schema_differences")
    i8 = stack_locations(survey.i8_old_north, survey.i8_old_south, survey.i8_new)
    cleaned = clean_locations(i8, survey.polygons, keep=keep)
    locations = finish(cleaned, "location_cleaned", by=["HGSIZE", "hgsize2"])
    conserve("location", i8, tables["screened_locations"])
    keep(location_slots(locations), "location_cleaned_wide")
    keep(range_sizes(tables["screened_locations"]), "location_range_sizes")
    keep(duplicate_rate(tables["screened_locations"], tables["located_points"]), "location_duplicate_rate")
    keep(dup_audit(locations.drop("Block").distinct(), ["id_loc"]), "location_duplicates")

    # Parties exist on the old forms only.
    leaders = leader_map(effort_rows(survey.i1_old))
    keep(dup_audit(leaders, ["ID_CODE"]), "leader_duplicates")
    trips = locations.select("ID_CODE", "id_loc", "year")
    keep(join_audit(trips, skew_join(trips, leaders, ["ID_CODE"], "left"), "id_loc", ["year"]), "leader_fan_out")
    i3 = union_by_name(survey.i3_old, survey.i3_new)
    oc = finish(observed_catch(i3, locations, survey.species, leaders, keep), "oc", by=["SP_CODE"])
    conserve("oc", i3, tables["screened_observed"])
    i2 = union_by_name(survey.i2_old, survey.i2_new)
    rc = finish(reported_catch(i2, locations, survey.species, leaders, keep), "rc", by=["SP_CODE"])
    conserve("rc", i2.distinct(), tables["screened_reported"])
    i1 = stack_effort(survey.i1_old, survey.i1_new)
    oe = finish(effort(i1, locations, survey.species, keep), "oe", by=["primary"])
    conserve("oe", i1, tables["effort_targets"])
    targeted = tables["effort_named"].filter(F.col("Common_Name").isNotNull())
    keep(group_sizes(targeted, ["TripType_Description"]), "target_types")

    table = finish(assemble(oc, rc, oe, keep), "all_by_id", ["year"])
    conserve("all_by_id", tables["assembled"], table, tables["all_by_id_notused"])
    keep(effort_without_catch(tables["assembled"]), "effort_without_catch")
    keep(combos(tables["assembled"]), "combos")
    keep(unmatched_blocks(table, survey.polygons, reasons.BLOCK_OFF_MAP), "blocks_off_map")
    keep(rows_off_map(table, survey.polygons, reasons.BLOCK_OFF_MAP), "blocks_off_map_rows")
    keep(weight_outliers(oc), "outliers_weight")
    keep(observed_rate_outliers(table), "outliers_observed")
    keep(reported_rate_outliers(table), "outliers_reported")
    keep(dup_audit(oc, ["id", "Block", "Common_Name"]), "oc_duplicates")
    keep(dup_audit(rc, ["id", "Block", "Common_Name"]), "rc_duplicates")
    keep(dup_audit(oe, ["id_noloc", "Block", "TripType_Description", "year"]), "oe_duplicates")
    keep(
        dup_audit(table, ["id", "Block", "Common_Name_catch", "TripType_Description_effort"]),
        "all_by_id_duplicates",
    )
    return tables
