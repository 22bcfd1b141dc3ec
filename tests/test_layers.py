import pytest
from pyspark.sql import functions as F

from creelgrid.operators import layers, species
from creelgrid.plans.map_layers import Choice, map_layers
from creelgrid.sources.readers import read_polygons

from conftest import values

TABLE = (
    "id string, year string, Block string, Common_Name_catch string, TripType_Description_effort string, "
    "Vessels double, AnglerDays double, Total_Obs_Fish_Caught double, Total_Rep_Fish_Caught double, Total_Fish_Caught double"
)


def trip(n, day, block, name, kind="Bottomfish", days=2.0, seen=1.0, told=0.0):
    return (f"ID1234{n}{day}001", day[:4], block, name, kind, 1.0, days, seen, told, seen + told)


@pytest.fixture
def table(spark):
    rows = [
        trip(1, "20040601", "X", "bocaccio"), trip(1, "20040601", "X", "lingcod", seen=3.0),
        trip(2, "20040701", "X", "bocaccio", days=4.0, told=5.0), trip(3, "20040601", "X", None, seen=0.0),
        trip(4, "20120601", "X", "vermilion", days=3.0), trip(5, "20120601", "Y", "bocaccio"),
        trip(6, "20120601", "Y", "bocaccio"), trip(7, "20120601", "Y", "bocaccio", kind="Inshore"),
    ]
    return spark.createDataFrame(rows, TABLE)


@pytest.fixture
def groups(spark):
    return spark.createDataFrame(
        [("bocaccio", "1", "0"), ("vermilion", "1", "0"), ("lingcod", "0", "1")], "Common_Name_catch string, Rockfish string, Other string"
    )


@pytest.fixture
def polygons(spark):
    ring = "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D), named_struct('x', 1D, 'y', 1D)))"
    return spark.sql(f"select id as NM_INDEX, {ring} as rings from values ('X'), ('Y') t(id)")


def rates(table, groups, name="Rockfish", kind="Bottomfish", period="year"):
    caught = species.select_trip(species.select_species(table, name, groups), kind)
    return layers.cpua(caught, species.select_trip(table, kind), name, period)


def test_rates(table, groups):
    got = values(rates(table, groups), "Block", "year", "AnglerDays", "n_samples_effort", "TotalCatch", "Kept", "Released", "CPUA_All", "CPUA_Kept")
    assert got == [
        ("X", "2004", 8.0, 3, 7.0, 2.0, 5.0, 0.875, 0.25),
        ("X", "2012", 3.0, 1, 1.0, 1.0, 0.0, 0.333, 0.333),
        ("Y", "2012", 4.0, 2, 2.0, 2.0, 0.0, 0.5, 0.5),
    ]


def test_all_trips_in_any_case(table, groups):
    for word in ("All", "ALL", "all"):
        got = rates(table, groups, "bocaccio", word)
        assert values(got.filter("Block = 'Y'"), "n_samples_effort", "TripType_Description_effort") == [(3, "All")]
        # effort without catch keeps the chosen name and rate 0
        assert values(got.filter("Block = 'X' and year = '2012'"), "Common_Name_catch", "CPUA_All") == [("bocaccio", 0.0)]


def test_minimum_samples(table, groups):
    joined = rates(table, groups)
    assert values(layers.layer_long(joined), "Block", "year") == [("X", "2004")]
    wide = layers.layer_wide(joined, "CPUA_All", 3, [2004, 2012])
    assert wide.columns == ["Block", "Catch", "Trip", "Y2004", "Y2012", "CPUA_All", "Samples"]
    assert values(wide) == [("X", "Rockfish", "Bottomfish", 0.875, 0.333, 0.727, 4)]
    grouped = layers.layer_grouped(joined, 2)
    assert grouped.columns[3:11] == [f"{m}_{r}" for m in ("All", "Kept") for r in ("04_09", "10_15", "16_20", "21_23")]
    assert values(grouped, "Block", "All_04_09", "Kept_10_15", "All_16_20", "CPUA_Kept") == [
        ("X", 0.875, 0.333, -9999.0, 0.273), ("Y", -9999.0, 0.5, -9999.0, 0.5),
    ]
    monthly = layers.layer_monthly(rates(layers.with_month(table), groups, period="month"), 2)
    assert values(monthly, "Block", "time", "Samples") == [("X", "1906", 3), ("Y", "1906", 2)]
    assert layers.present_years(joined) == [2004, 2012]
    assert layers.rate_audit(joined, [2004], [("04", 2004, 2004)]).first() == (3, 0, 2, 2)


def test_unknown_choices(spark, table, groups, polygons):
    with pytest.raises(ValueError):
        map_layers(spark, table, polygons, Choice("Bocacio"), groups)
    with pytest.raises(ValueError):
        layers.layer_wide(table, "CPUA_Other")


def test_plan_writes_layers(spark, table, groups, polygons, tmp_path):
    placed = map_layers(spark, table, polygons, Choice("Rockfish", "Bottomfish", 2), groups, str(tmp_path))
    assert set(placed) == {"long", "CPUA_All", "GROUPS", "monthly"}
    assert placed["CPUA_All"].columns == ["Block", "Catch", "Trip", "Y2004", "Y2012", "CPUA_All", "Samples", "rings"]
    names = {p.name for p in tmp_path.iterdir()}
    kinds = ("long", "CPUA_All", "GROUPS", "monthly", "cpua_year", "audit")
    assert names == {f"Rockfish_Bottomfish_2_SAMPLES_{kind}" for kind in kinds}
    back = read_polygons(spark, str(tmp_path / "Rockfish_Bottomfish_2_SAMPLES_long"), id_column="Block")
    assert values(back.select("NM_INDEX", F.size("rings"))) == [("X", 1), ("Y", 1)]


def test_years_and_months_from_one_scan(spark, table, groups):
    """The same rates as by two separate runs, also for odd rows, a species alone and all trips; one scan of the table."""
    odd = spark.createDataFrame(
        [
            trip(8, "20120601", None, "bocaccio"), trip(9, "20120601", "Y", "bocaccio", kind=None),
            ("ID1", None, "Y", "bocaccio", "Bottomfish", None, None, None, 2.0, 2.0),
            trip(5, "20120601", "Y", "vermilion", days=5.0), trip(6, "20120601", "Y", "bocaccio"),
            ("ID1234520120601001", "2004", "Y", "bocaccio", "Bottomfish", 1.0, 2.0, 1.0, 0.0, 1.0),
        ],
        TABLE,
    )
    rows = layers.with_month(table.unionByName(odd))
    for name, kind, of in (("Rockfish", "Bottomfish", groups), ("bocaccio", "All", groups), ("lingcod", "Inshore", None)):
        flagged = species.select_trip(species.flag_species(rows, name, of), kind)
        both = layers.cpua_periods(flagged, name)
        for period in ("year", "month"):
            caught = species.select_trip(species.select_species(rows, name, of), kind)
            want = layers.cpua(caught, species.select_trip(rows, kind), name, period)
            assert values(layers.of_period(both, period), *want.columns) == values(want)


def test_one_scan_of_the_table(spark, table, groups, tmp_path):
    table.write.parquet(str(tmp_path / "all_by_id"))
    stored = layers.with_month(spark.read.parquet(str(tmp_path / "all_by_id")))
    both = layers.cpua_periods(species.flag_species(stored, "bocaccio"), "bocaccio")
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Join") == 0 and plan.count("Expand") == 1
