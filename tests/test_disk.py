"""What steps leave on the disk and send through shuffles."""

import os

import pytest
from pyspark.sql import functions as F

from creelgrid import session
from creelgrid.operators import assemble, catch, dedupe, joins, species

from conftest import text_frame, values
from test_effort_and_catch import I2, I3, SPECIES, leaders
from test_hot_trips import everywhere, trips


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def lookup(spark):
    return species.clean_species(text_frame(spark, ["PSMFC_Code", "ALPHA5", "Common_Name", "TripType_Description"], SPECIES))


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirsString() for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_written_step_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    counts = session.stage_table(spark.range(50_000).groupBy((F.col("id") % 7_000).alias("k")).count(), "counts")
    assert not shuffle_files(spark) - before
    assert counts.count() == 7_000
    assert spark.conf.get(session.CLEANUP) == "false"


@pytest.mark.parametrize("kind", ["observed", "reported"])
def test_blocks_multiply_after_the_last_shuffle(spark, lookup, no_broadcast, kind):
    code = F.when(F.col("id") % 2 == 0, "8827010201").otherwise("8857030309")
    if kind == "observed":
        raw = trips(spark, I3, SP_CODE=code, FSHINSP=F.lit("6"), WGT=F.lit("1.5"))
        step = catch.observed_catch
    else:
        raw = trips(spark, I2, SP_CODE=code, DISPO=F.lit("1"), NUM_FISH=F.lit("4"))
        step = catch.reported_catch
    written = len(session._stages.get(spark.sparkContext.applicationId, []))
    kept = step(raw, everywhere(spark), lookup, leaders(spark, ("IDnone", "IDnone"))).kept
    assert len(session._stages.get(spark.sparkContext.applicationId, [])) == written  # rejects that nobody asked for are not made
    above = plan_of(kept).split("Generate inline(blocks")[0]
    assert "Exchange" not in above and "HashAggregate" in above


def test_a_code_with_two_names(spark, lookup):
    """Its fish are seen under both names, each a half; of its reported rows none is the only one."""
    twice = lookup.unionByName(lookup.filter("SP_CODE = 8827010201").withColumn("Common_Name", F.lit("other")))
    raw = text_frame(spark, I3, [tuple({"ID_CODE": "t1", "YEAR": "2012", "SP_CODE": "8827010201", "FSHINSP": "6", "WGT": "1.5"}.get(c) for c in I3)])
    kept = catch.observed_catch(raw, everywhere(spark), twice, leaders(spark, ("IDnone", "IDnone"))).kept
    assert values(kept.filter("Block = 'X-1'"), "Common_Name", "Total_Obs_Fish_Caught", "Ob_Weighed_Fish") == [("lingcod", 1.5, 1), ("other", 1.5, 1)]
    raw = text_frame(spark, I2, [tuple({"ID_CODE": "t1", "YEAR": "2012", "SP_CODE": "8827010201", "DISPO": "1", "NUM_FISH": "4"}.get(c) for c in I2)])
    assert catch.reported_catch(raw, everywhere(spark), twice, leaders(spark, ("IDnone", "IDnone"))).kept.isEmpty()


def test_copies_of_reported_rows(spark):
    """Exact copies are one row; rows that differ in anything, be it how a blank is written, are two."""
    row = {"ID_CODE": "t1", "YEAR": "2012", "SP_CODE": "8827010201", "DISPO": "1", "NUM_FISH": "4"}
    rows = [row, row, {**row, "DISPO": "2"}, {**row, "DISPO": "2", "NUM_FISH": None}, {**row, "DISPO": None}, {**row, "ID_CODE": "t2"}, {**row, "ID_CODE": "t2", "YEAR": None}]
    frame = text_frame(spark, I2, [tuple(r.get(c) for c in I2) for r in rows])
    got = catch.unambiguous(frame)
    assert values(got, "id", "DISPO", "fish") == [("IDt11", "1", 4.0), ("IDt11", None, 4.0)]


def test_merged_locations_write_no_table(spark):
    rows = spark.range(5_000).selectExpr("cast(id % 900 as string) as k", "if(id = 3, 'n', 'm') as mode", "cast(id % 3 as string) as Block")
    written = len(session._stages.get(spark.sparkContext.applicationId, []))
    stage = dedupe.consolidate_blocks(rows, "k", ["mode"])
    assert stage.kept.count() == 899 and stage.rejects.count() == 2
    assert len(session._stages.get(spark.sparkContext.applicationId, [])) == written


def test_rows_of_a_trip_move_together(spark, no_broadcast):
    left = spark.createDataFrame([("a", "1", "x", 1), ("a", "2", None, 2), ("b", "1", "x", 3), ("c", "1", None, 4)], "k string, b string, y string, v int")
    right = spark.createDataFrame([("a", "1", "x", 5), ("a", "1", "x", 6), ("a", "2", "x", 7), ("a", "2", None, 8), ("d", "1", None, 9)], "j string, b string, y string, w int")
    on = [("k", "j"), "b", "y"]
    got = joins.full_join(left, right, on, null_safe=["y"], split_right=False, together="k")
    assert values(got) == values(joins.full_join(left, right, on, null_safe=["y"], split_right=False))
    assert "hashpartitioning(__lh" in plan_of(got) and got.count() == 7
    both = assemble.all_catch(
        left.selectExpr("k as id", "k as ID_CODE", "1D as SP_CODE", "b as Block", "'n' as Common_Name", "'t' as TripType_Description", "y as year", "'1' as locn", "v"),
        left.selectExpr("k as id", "k as ID_CODE", "1D as SP_CODE", "b as Block", "'n' as Common_Name", "'t' as TripType_Description", "y as year", "v as w"),
    )
    assert plan_of(both).count("Exchange") == 1 and "Exchange hashpartitioning(ID_CODE" in plan_of(both)
    assert values(both, "v", "w") == [(1, 1), (2, 2), (3, 3), (4, 4)]
