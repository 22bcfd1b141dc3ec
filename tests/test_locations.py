from pyspark.sql import functions as F

from creelgrid import reasons as R
from creelgrid.operators import locations as L
from creelgrid.operators.rejects import REASON, reconcile

from conftest import text_frame, values

COLUMNS = [
    "ID_CODE", "locn", "YEAR", "MODE_FX", "survey", "ddlat", "ddlong", "block1", "box1a", "box1b", "box1c",
    "block2", "box2a", "box2b", "box2c", "HGSIZE", "hgsize2",
]


def row(id_code, **given):
    base = dict.fromkeys(COLUMNS)
    base.update(ID_CODE=id_code, YEAR="2012", MODE_FX="7", survey="PR1", **given)
    return [base[c] for c in COLUMNS]


def square(name, x, y, size=1.0, hole=None):
    def ring(a, b, s):
        return [(a, b), (a + s, b), (a + s, b + s), (a, b + s)]

    rings = [ring(x, y, size)]
    if hole:
        rings.append(ring(*hole))
    return (name, [[tuple(map(float, p)) for p in r] for r in rings])


def polygons(spark):
    rows = [
        square("A", -123, 36), square("B", -122, 36), square("C", -121.5, 36),
        square("H", -118, 36, 3, hole=(-117, 37, 1)),
    ]
    return spark.createDataFrame(rows, "NM_INDEX string, rings array<array<struct<x: double, y: double>>>")


def clean(spark, rows):
    return L.clean_locations(text_frame(spark, COLUMNS, rows), polygons(spark))


def reasons_of(stage):
    return {r["id_loc"]: r[REASON] for r in stage.rejects.collect()}


def test_screens(spark):
    rows = [
        row("mode6", block1="1035") [:3] + ["6"] + row("mode6", block1="1035")[4:],
        row("nomode", block1="1035")[:3] + [None] + row("nomode", block1="1035")[4:],
        row("nothing"),
        row("shortblock", block1="123"),
        row("sentinel", block1="9999999", box1a="045"),
        row("range", block1="1035", HGSIZE="3"),
        row("rangetext", block1="1035", hgsize2="many"),
        row("rangeok", block1="1035", HGSIZE="1", hgsize2="0"),
        row("north", ddlat="51", ddlong="122"),
        row("west", ddlat="36", ddlong="151"),
        row("nolong", ddlat="36"),
        row("limit", ddlat="50", ddlong="122"),
        row("badlat", ddlat="bad", ddlong="122"),
        row("off", ddlat="10", ddlong="122"),
        row(None, block1="1035"),
    ]
    stage = clean(spark, rows)
    assert reasons_of(stage) == {
        "mode61": R.LOCATION_NOT_BOAT,
        "nomode1": R.LOCATION_NOT_BOAT,
        "nothing1": R.LOCATION_EMPTY,
        "shortblock1": R.LOCATION_EMPTY,
        "sentinel1": R.LOCATION_EMPTY,
        "range1": R.LOCATION_RANGE,
        "rangetext1": R.LOCATION_RANGE,
        "north1": R.LOCATION_BAD_COORDS,
        "west1": R.LOCATION_BAD_COORDS,
        "nolong1": R.LOCATION_BAD_COORDS,
        "limit1": R.LOCATION_UNUSABLE_COORDS,
        "badlat1": R.LOCATION_UNUSABLE_COORDS,
        "off1": R.LOCATION_OFF_MAP,
        None: R.MISSING_ID,
    }
    assert values(stage.kept, "id_loc", "Block", "total_blocks") == [("IDrangeok1", "1035-", 1)]
    counted = {r[REASON]: r["Count"] for r in stage.summary().collect()}
    assert counted[R.LOCATION_CONFLICT] == 0 and counted[R.LOCATION_EMPTY] == 3
    before = text_frame(spark, COLUMNS, rows)
    assert reconcile(before, stage.kept, stage.rejects).first()["balanced"]


def test_points(spark):
    rows = [
        row("inside", ddlat="36.5", ddlong="122.5"),
        row("edge", ddlat="36.5", ddlong="122"),
        row("overlap", ddlat="36.5", ddlong="121.25"),
        row("hole", ddlat="37.5", ddlong="116.5"),
        row("holeedge", ddlat="37", ddlong="116.5"),
        row("outside", ddlat="20", ddlong="120"),
        row("both", ddlat="20", ddlong="120", block1="1035"),
    ]
    stage = clean(spark, rows)
    assert values(stage.kept, "id_loc", "Block", "total_blocks") == [
        ("IDboth1", "1035-", 1),
        ("IDedge1", "A", 2), ("IDedge1", "B", 2),
        ("IDholeedge1", "H", 1),
        ("IDinside1", "A", 1),
        ("IDoverlap1", "B", 2), ("IDoverlap1", "C", 2),
    ]
    assert set(reasons_of(stage)) == {"hole1", "outside1"}


def test_merging(spark):
    rows = [
        row("same", block1="1035", box1a="001"),
        row("same", block1="1036", locn="0"),
        row("same", block1="1036", locn="01"),
        row("two", block1="1035", locn="1"),
        row("two", block1="1037", locn="2"),
        *[row("many", block1=str(1000 + i)) for i in range(12)],
        row("twice", block1="1035", box1a="7", box1b="7", block2="1035", box2a="7"),
    ]
    conflict = row("clash", block1="1035")
    other = row("clash", block1="1036")
    other[4] = "PR2"
    stage = clean(spark, rows + [conflict, other, conflict])
    totals = {r["id_loc"]: r["total_blocks"] for r in stage.kept.collect()}
    # a four-digit block is a code even without a box
    assert totals == {"IDsame1": 3, "IDtwo1": 1, "IDtwo2": 1, "IDmany1": 12, "IDtwice1": 2}
    assert values(stage.rejects, "id_loc", "survey") == [("clash1", "PR1"), ("clash1", "PR2")]
    wide = {r["id_loc"]: r for r in L.location_slots(stage.kept).collect()}
    assert wide["IDmany1"]["Bk1Bx1a"] == "1000-" and wide["IDmany1"]["extrablock11"] == "1010-"
    assert wide["IDmany1"]["more_blocks"] == "1011-"
    assert wide["IDsame1"]["Bk1Bx1c"] == "1036-" and wide["IDsame1"]["more_blocks"] is None


def test_stacking_leaves_the_replaced_year(spark):
    old = text_frame(spark, ["ID_CODE", "YEAR"], [("a", "2015"), ("b", "2016"), ("c", None), ("e", "20I2")])
    new = text_frame(spark, ["id_code", "YEAR", "extra"], [("d", "2016", "x")])
    out = L.stack_locations(old, old.filter(F.lit(False)), new)
    assert values(out, "ID_CODE", "YEAR", "extra", "stack_reason") == [
        ("a", "2015", None, None), ("b", "2016", None, R.LOCATION_REPLACED), ("c", None, None, R.LOCATION_NO_YEAR),
        ("d", "2016", "x", None), ("e", "20I2", None, None),
    ]
