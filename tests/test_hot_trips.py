"""A third of all rows under one trip, species, leader or group of copies."""

import pytest
from pyspark.sql import functions as F

from creelgrid import reasons as R
from creelgrid.operators import catch, effort, species
from creelgrid.operators.rejects import REASON

from conftest import text_frame
from test_effort_and_catch import I1, I2, I3, SPECIES, leaders, locations, place

N = 9_000


@pytest.fixture(scope="module")
def lookup(spark):
    raw = text_frame(spark, ["PSMFC_Code", "ALPHA5", "Common_Name", "TripType_Description"], SPECIES)
    return species.clean_species(raw)


def trips(spark, columns, **given):
    """N rows, every third of the trip ``hot``, the others of trips of their own."""
    own = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id"))
    base = {c: F.lit(None).cast("string") for c in columns}
    base |= {"ID_CODE": own, "YEAR": F.lit("2012"), **given}
    return spark.range(N).select(*[base[c].cast("string").alias(c) for c in columns])


def everywhere(spark):
    own = spark.range(N).filter("id % 3 <> 0").selectExpr("concat('t', id) as trip")
    return (
        own.unionByName(spark.sql("select 'hot' as trip"))
        .selectExpr(
            "concat('ID', trip, '1') as id_loc", "'2012' as year", "concat('ID', trip) as ID_CODE", "'7' as MODE_FX",
            "'PR1' as survey", "explode(array('X-1', 'Y-2')) as Block", "2 as total_blocks",
        )
    )


def test_observed(spark, lookup):
    raw = trips(spark, I3, SP_CODE=F.lit("8827010201"), FSHINSP=F.lit("6"), WGT=F.lit("1.5"))
    stage = catch.observed_catch(raw, everywhere(spark), lookup, leaders(spark, ("IDnone", "IDnone")))
    rows = {r["id"]: r for r in stage.kept.filter("Block = 'X-1'").collect()}
    assert len(rows) == 1 + N * 2 // 3
    assert rows["IDhot1"]["Total_Obs_Fish_Caught"] == pytest.approx(3.0)
    assert rows["IDhot1"]["Ob_Weighed_Fish"] == N // 3
    assert rows["IDt11"]["Total_Obs_Fish_Caught"] == pytest.approx(3.0)
    # fish over all blocks are the fish before they were spread
    assert stage.kept.agg(F.sum("Total_Obs_Fish_Caught")).first()[0] == pytest.approx(6.0 * len(rows))


def test_reported(spark, lookup):
    raw = trips(spark, I2, SP_CODE=F.lit("8827010201"), DISPO=F.lit("1"), NUM_FISH=F.col("id"))
    stage = catch.reported_catch(raw, everywhere(spark), lookup, leaders(spark, ("IDnone", "IDnone")))
    assert stage.kept.count() == 2 * (N * 2 // 3)
    counts = {r[REASON]: r["Count"] for r in stage.summary().collect()}
    assert counts[R.CATCH_AMBIGUOUS] == N // 3 and sum(counts.values()) == N // 3
    copies = trips(spark, I2, SP_CODE=F.lit("8827010201"), DISPO=F.lit("1"), NUM_FISH=F.lit("4"))
    whole = catch.reported_catch(copies, everywhere(spark), lookup, leaders(spark, ("IDnone", "IDnone")))
    assert whole.kept.filter("id = 'IDhot1'").select("Rep_Released").distinct().collect() == [(2.0,)]


def test_effort(spark, lookup):
    given = {"prim1": F.lit("8827010201"), "DAYSF": F.lit("1"), "survey": F.lit("PR1")}
    copies = trips(spark, I1, CNTRBTRS=F.lit("2"), **given)
    stage = effort.effort(copies, everywhere(spark), lookup)
    assert stage.kept.count() == 2 * (1 + N * 2 // 3)
    different = trips(spark, I1, CNTRBTRS=F.col("id") + 1, **given)
    stage = effort.effort(different, everywhere(spark), lookup)
    assert stage.kept.count() == 2 * (N * 2 // 3)
    assert {r[REASON]: r["Count"] for r in stage.summary().collect()}[R.EFFORT_AMBIGUOUS] == N // 3


def test_leader(spark, lookup):
    boss = F.when(F.col("id") == 0, F.lit(None)).otherwise("boss")
    own = F.when(F.col("id") == 0, "boss").otherwise(F.concat(F.lit("t"), "id"))
    raw = trips(
        spark, I1, ID_CODE=own, LEADER=boss, FIRST=F.lit("1"), CNTRBTRS=F.lit("2"), DAYSF=F.lit("1"),
        prim1=F.lit("8827010201"),
    )
    stage = effort.effort(raw, locations(spark, place("boss", 1, "X-1")), lookup)
    assert [tuple(r) for r in stage.kept.select("id_noloc", "Cntrbs").collect()] == [("IDboss", 2.0 * N)]


def test_assembly_of_a_hot_trip_is_split(spark):
    """A third of the catch lies in one block and year of one trip."""
    from creelgrid.operators import assemble as A
    from creelgrid.session import stage_table

    catch = spark.range(150_000).selectExpr(
        "'x' as id", "if(id % 3 = 0, 'hot', cast(id as string)) as ID_CODE", "cast(id as double) as SP_CODE", "'B' as Block",
        "md5(cast(id as string)) as Common_Name", "'t' as TripType_Description", "if(id % 5 = 1, null, '2012') as year", "1D as Total_Obs_Fish_Caught",
    )
    effort = spark.range(40_000).selectExpr(
        "if(id = 0, 'hot', cast(id * 7 as string)) as id_noloc", "'2012' as year", "'B' as Block", "'n' as Common_Name", "'t' as TripType_Description", "2D as AnglerDays",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        catch, effort = stage_table(catch, "hot_catch"), stage_table(effort, "hot_effort")
        joined = A.with_effort(catch, effort)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "FullOuter" not in plan
        same = (catch.ID_CODE == effort.id_noloc) & (catch.Block == effort.Block) & catch.year.eqNullSafe(effort.year)
        want = catch.join(effort, same, "full")
        assert joined.count() == want.count()
        assert joined.filter("AnglerDays = 2 and SP_CODE is not null").count() == want.filter("AnglerDays = 2 and SP_CODE is not null").count() > 30_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
