import pytest
from pyspark.sql import functions as F

from creelgrid import reasons as R
from creelgrid.operators import assemble as A
from creelgrid.operators import catch, effort, party, species
from creelgrid.operators.rejects import REASON

from conftest import text_frame, values

SPECIES = [
    ("8827010201", "LNGCD", "lingcod      ", "Bottomfish"),
    ("8826010127", "RFBOC", "bocaccio     ", "Bottomfish"),
    ("8857030309", "HALCA", "California halibut ", "Inshore"),
    ("5102030100", "ABALO", "abalone genus  ", "Invertebrates"),
    ("5500000000", "BIVAL", "bivalve class  ", "Invertebrates"),
    ("5500000000", "CLAMS", "clams          ", "Invertebrates"),
    ("", "NFABA", "abalone       ", "Non-fishing"),
]
I1 = ["ID_CODE", "YEAR", "prim1", "prim2", "CNTRBTRS", "DAYSF", "LEADER", "PRT_CODE", "FIRST", "survey"]


@pytest.fixture(scope="module")
def lookup(spark):
    raw = text_frame(spark, ["PSMFC_Code", "ALPHA5", "Common_Name", "TripType_Description"], SPECIES)
    return species.clean_species(raw).cache()


def locations(spark, rows):
    return spark.createDataFrame(
        rows, "id_loc string, year string, ID_CODE string, MODE_FX string, survey string, Block string, total_blocks int"
    )


def place(trip, locn, *blocks):
    return [(f"ID{trip}{locn}", "2012", f"ID{trip}", "7", "PR1", b, len(blocks)) for b in blocks]


def test_species_lookup(lookup):
    assert lookup.filter("SP_CODE = 5500000000").select("Common_Name").collect()[0][0] == "clams"
    assert lookup.count() == 6
    assert species.target_species(lookup).count() == 5


def test_primary_target(spark, lookup):
    rows = [
        ("a", "2012", "5102030100", "8827010201"), ("b", "2012", "5102030100", None),
        ("c", "2012", "8827010201", "8857030309"), ("d", "2012", "NFOTH", "8827010201"), ("e", "2012", None, "8827010201"),
    ]
    df = text_frame(spark, I1[:4], rows)
    assert values(species.primary_target(df, lookup), "ID_CODE", "primary") == [
        ("a", "8827010201"), ("b", "5102030100"), ("c", "8827010201"), ("d", "NFOTH"), ("e", None),
    ]


def i1(spark, *rows):
    base = dict.fromkeys(I1)
    out = []
    for r in rows:
        given = {**base, "YEAR": "2012", "prim1": "8827010201", "CNTRBTRS": "1", "DAYSF": "1", "survey": "PR1", **r}
        out.append([given[c] for c in I1])
    return text_frame(spark, I1, out)


def test_effort(spark, lookup):
    form = {"survey": None}
    raw = i1(
        spark,
        {"ID_CODE": "plain", "CNTRBTRS": "2", "DAYSF": "0"},
        {"ID_CODE": "idle", "CNTRBTRS": None},
        {"ID_CODE": "odd", "CNTRBTRS": "x"},
        {"ID_CODE": "lead", "FIRST": "1", "CNTRBTRS": "2", "DAYSF": "3", **form},
        {"ID_CODE": "f1", "LEADER": "lead", "CNTRBTRS": "3", **form},
        {"ID_CODE": "f2", "PRT_CODE": "lead", "CNTRBTRS": "4", **form},
        {"ID_CODE": "lost", "LEADER": "nobody", **form},
        {"ID_CODE": "nolink", "FIRST": "2", **form},
        {"ID_CODE": "late", "YEAR": "2014", "LEADER": "lead", **form},
        {"ID_CODE": "nospecies", "prim1": "NFOTH"},
        {"ID_CODE": "nowhere"},
        {"ID_CODE": "dup", "CNTRBTRS": "2"}, {"ID_CODE": "dup", "CNTRBTRS": "3"},
        {"ID_CODE": "copy", "CNTRBTRS": "2"}, {"ID_CODE": "copy", "CNTRBTRS": "2"},
    )
    names = ("plain", "idle", "odd", "lead", "f1", "f2", "late", "nospecies", "dup", "copy")
    spots = [r for n in names for r in place(n, 1, "X-1")]
    spots += place("lead", 2, "X-1", "Y-2") + place("idle", 2, "Y-2")
    stage = effort.effort(raw, locations(spark, spots), lookup)
    assert values(stage.kept, "id_noloc", "Block", "Days", "Cntrbs", "Vessels", "AnglerDays") == [
        ("IDcopy", "X-1", 1.0, 2.0, 1.0, 2.0),
        ("IDlate", "X-1", 1.0, 1.0, 1.0, 1.0),
        ("IDlead", "X-1", 3.0, 9.0, 1.0, 27.0),
        ("IDlead", "Y-2", 3.0, 9.0, 1.0, 27.0),
        ("IDplain", "X-1", 1.0, 2.0, 1.0, 2.0),
    ]
    rejected = stage.rejects.groupBy(REASON).count().collect()
    assert {r[0]: r[1] for r in rejected} == {
        R.EFFORT_UNPLACED: 1, R.EFFORT_FOLLOWER_ALONE: 1, R.EFFORT_NO_SPECIES: 1, R.NO_LOCATION: 1,
        R.EFFORT_NO_CONTRIBUTORS: 2, R.EFFORT_BAD_CONTRIBUTORS: 1, R.EFFORT_AMBIGUOUS: 2,
    }
    assert effort.aggregate_effort(
        effort.effort_by_block(
            spark.createDataFrame(
                [("IDlead", "2012", "lingcod", "Bottomfish", 2.0, 3.0), ("IDlead", "2012", "lingcod", "Bottomfish", 4.0, 1.0)],
                "id string, year string, Common_Name string, TripType_Description string, CNTRBTRS double, DAYSF double",
            ),
            locations(spark, place("lead", 1, "X-1")),
        )
    ).select("Days", "Cntrbs", "Vessels", "AnglerDays").first() == (4.0, 6.0, 2.0, 24.0)


def test_party_roles_cover_every_form(spark):
    links = [(l, p, f) for l in (None, "a") for p in (None, "b") for f in (None, "1", "2")]
    rows = [{"ID_CODE": f"t{i}", "LEADER": l, "PRT_CODE": p, "FIRST": f, "survey": None} for i, (l, p, f) in enumerate(links)]
    roled = party.party_role(effort.effort_rows(i1(spark, *rows)))
    roles = {r["id"]: r["role"] for r in roled.collect()}
    assert {roles[f"t{i}"] for i, (l, p, f) in enumerate(links) if l or p} == {"follower"}
    assert [roles[f"t{i}"] for i, (l, p, f) in enumerate(links) if not (l or p)] == ["unplaced", "leader", "unplaced"]


def test_rollup_conserves_contributors(spark):
    rows = [{"ID_CODE": "L", "FIRST": "1", "CNTRBTRS": "2", "survey": None}]
    rows += [{"ID_CODE": f"F{i}", "LEADER": "L", "CNTRBTRS": str(i), "survey": None} for i in range(50)]
    df = effort.normalise_effort(effort.effort_rows(i1(spark, *rows)))
    assert party.rollup_parties(df).kept.agg(F.sum("CNTRBTRS")).first()[0] == 2 + sum(range(50))


I3 = ["ID_CODE", "locn", "YEAR", "SP_CODE", "MODE_F", "DISP3", "WGT", "FSHINSP"]


def leaders(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ID_CODE string, LEADER_ID string")


def test_observed(spark, lookup):
    def fish(id_code, weight, n="3", code="8827010201", locn=None):
        return (id_code, locn, "2012", code, "7", "1", weight, n)

    raw = text_frame(
        spark, I3,
        [fish("t", "1.0"), fish("t", "2.0"), fish("t", "WGT"), fish("u", "5", n=None), fish("m", "4", n="2"),
         fish("t", "1", code="LNGCD"), fish("t", "1", code="999"), fish("gone", "1"), fish("t", "7", n="1", locn="2")],
    )
    spots = locations(spark, place("t", 1, "X-1", "Y-2") + place("t", 2, "Z-3") + place("u", 1, "X-1") + place("m", 1, "X-1"))
    stage = catch.observed_catch(raw, spots, lookup, leaders(spark, ("IDm", "IDt")))
    got = values(stage.kept, "id", "Block", "Total_Obs_Fish_Caught", "Ob_AvKWgt", "Ob_Weighed_Fish")
    # the member's fish are booked under its leader, in the same block
    assert got == [
        ("IDt1", "X-1", 3.5, pytest.approx(7 / 3), 3),
        ("IDt1", "Y-2", 1.5, 1.5, 2),
        ("IDt2", "Z-3", 1.0, 7.0, 1),
        ("IDu1", "X-1", 0.0, 5.0, 1),
    ]
    assert {r[REASON] for r in stage.rejects.collect()} == {R.CATCH_BAD_CODE, R.CATCH_NO_SPECIES, R.NO_LOCATION}
    assert {r[REASON]: r["Count"] for r in stage.summary().collect()}[R.MISSING_ID] == 0


def test_leader_listed_twice_counts_twice(spark, lookup):
    raw = text_frame(spark, I3, [("m", "1", "2012", "8827010201", "7", "1", w, "3") for w in ("1", "2", None)])
    spots = locations(spark, place("m", 1, "X-1"))
    twice = leaders(spark, ("IDm", "IDt"), ("IDm", "IDt"), ("IDm", "IDs"))
    got = catch.observed_catch(raw, spots, lookup, twice).kept
    assert values(got, "id", "Total_Obs_Fish_Caught", "Ob_AvKWgt", "Ob_Weighed_Fish") == [
        ("IDs1", 3.0, 1.5, 2), ("IDt1", 6.0, 1.5, 4),
    ]


I2 = ["ID_CODE", "locn", "YEAR", "SP_CODE", "DISPO", "NUM_FISH"]


def test_reported(spark, lookup):
    def caught(id_code, dispo, n, code="8827010201"):
        return (id_code, "1", "2012", code, dispo, n)

    raw = text_frame(
        spark, I2,
        [caught("t", str(d), "2") for d in range(1, 8)] + [caught("t", "9", "50")]
        + [caught("t", "1", "2")]
        + [caught("d", "1", "2"), caught("d", "1", "3"), caught("d", "6", "4")]
        + [caught("n", None, "1"), caught("gone", "1", "1"), caught("t", "1", "1", "LNGCD")],
    )
    spots = locations(spark, place("t", 1, "X-1", "Y-2") + place("d", 1, "X-1") + place("n", 1, "X-1"))
    stage = catch.reported_catch(raw, spots, lookup, leaders(spark))
    columns = ["id", "Block", "Rep_Released_Alive", "Rep_Released_Dead", "Rep_Kept", "Total_Rep_Fish_Caught", "Rep_Released"]
    assert values(stage.kept, *columns) == [
        ("IDd1", "X-1", 0.0, 4.0, 0.0, 4.0, 4.0),
        ("IDn1", "X-1", 0.0, 0.0, 0.0, 0.0, 0.0),
        ("IDt1", "X-1", 2.0, 1.0, 4.0, 7.0, 3.0),
        ("IDt1", "Y-2", 2.0, 1.0, 4.0, 7.0, 3.0),
    ]
    assert {r[REASON]: r["Count"] for r in stage.summary().collect()} == {
        R.MISSING_ID: 0, R.CATCH_BAD_CODE: 1, R.CATCH_NO_SPECIES: 0, R.NO_LOCATION: 1, R.CATCH_AMBIGUOUS: 2,
    }


def test_assemble(spark):
    oc = spark.createDataFrame(
        [("IDt1", "IDt", "1", "2012", "X", 8827010201.0, "lingcod", "Bottomfish", 2.0, None, 0),
         ("IDn1", "IDn", "1", None, "X", 8827010201.0, "lingcod", "Bottomfish", 5.0, 1.0, 1),
         ("IDz1", "IDz", "1", "2012", "X", 8827010201.0, "lingcod", "Bottomfish", 1.0, 1.0, 1)],
        "id string, ID_CODE string, locn string, year string, Block string, SP_CODE double, Common_Name string, TripType_Description string, "
        "Total_Obs_Fish_Caught double, Ob_AvKWgt double, Ob_Weighed_Fish bigint",
    )
    rc = spark.createDataFrame(
        [("IDt1", "IDt", "2012", "X", 8827010201.0, "lingcod", "Bottomfish", 1.0, 1.0, 1.0, 3.0, 2.0),
         ("IDt1", "IDt", "2012", "X", 8857030309.0, "California halibut", "Inshore", 0.0, 0.0, 4.0, 4.0, 0.0)],
        "id string, ID_CODE string, year string, Block string, SP_CODE double, Common_Name string, TripType_Description string, "
        "Rep_Released_Alive double, Rep_Released_Dead double, Rep_Kept double, Total_Rep_Fish_Caught double, Rep_Released double",
    )
    oe = spark.createDataFrame(
        [("IDt", "2012", "X", "lingcod", "Bottomfish", 1.0, 2.0, 1.0, 2.0),
         ("IDn", None, "X", "lingcod", "Bottomfish", 1.0, 1.0, 1.0, 1.0),
         ("IDe", "2012", "X", "lingcod", "Bottomfish", 1.0, 1.0, 1.0, 1.0)],
        "id_noloc string, year string, Block string, Common_Name string, TripType_Description string, "
        "Days double, Cntrbs double, Vessels double, AnglerDays double",
    )
    stage = A.assemble(oc, rc, oe)
    columns = ["id", "SP_CODE", "TripType_Description_catch", "Ob_AvKWgt", "Total_Fish_Caught", "AnglerDays"]
    assert values(stage.kept, *columns) == [
        ("IDe", None, None, 0.0, 0.0, 1.0),
        ("IDn1", 8827010201.0, "Bottomfish", 1.0, 5.0, 1.0),
        ("IDt1", 8827010201.0, "Bottomfish", 0.0, 5.0, 2.0),
        ("IDt1", 8857030309.0, "Inshore", 0.0, 4.0, 2.0),
    ]
    assert values(stage.rejects, "id", REASON) == [("IDz1", R.CATCH_NO_EFFORT)]
    assert values(A.effort_without_catch(A.with_effort(A.all_catch(oc, rc), oe)), "id") == [("IDe",)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stage.kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 4
