import csv
import json
import time

import pytest
from pyspark.sql import functions as F

from creelgrid import reasons as R
from creelgrid import session
from creelgrid.operators import species
from creelgrid.operators.rejects import REASON
from creelgrid.plans.ingest import ingest
from creelgrid.plans.rebuild import Survey, rebuild
from creelgrid.sources import readers, writers

from conftest import text_frame, values
from test_effort_and_catch import I1, I2, I3, SPECIES
from test_locations import COLUMNS as I8
from test_locations import polygons


def put(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


def test_raw_text(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("id,a,b\n0123456789012345678901,., x \n2,NA\n3,,\n")
    df = readers.read_raw(spark, str(path))
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert values(df) == [("0123456789012345678901", None, "x"), ("2", None, None), ("3", None, None)]
    assert values(readers.read_raw(spark, str(path), null_tokens=("",)), "a")[0] == (".",)


def test_yearly_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for year in (2016, 2017):
        put(folder / f"PR1_i1_{year}.csv", ["id_code", "YEAR"], [(f"a{year}", year)])
        put(folder / f"PR2_i1_{year}.csv", ["id_code", "YEAR"], [(f"b{year}", year)])
        put(folder / f"PR1_i8_{year}.csv", ["id_code", "block1"], [(f"c{year}", "0123")])
    tables = ingest(spark, str(folder), str(tmp_path / "out"), kinds=("i1", "i8"))
    assert values(tables["i1"], "id_code") == [("a2016",), ("a2017",), ("b2016",), ("b2017",)]
    assert values(tables["i8"], "block1") == [("0123",), ("0123",)]
    files = readers.read_yearly(spark, str(folder), "i8", with_file=True)
    assert values(files, "file_name") == [("PR1_i8_2016.csv",), ("PR1_i8_2017.csv",)]


def test_files_with_other_column_orders(spark, tmp_path):
    a = put(tmp_path / "a_i1.csv", ["id_code", "YEAR"], [("a", 2016)])
    b = put(tmp_path / "b_i1.csv", ["YEAR", "id_code"], [(2017, "b")])
    assert values(readers.read_raw(spark, [a, b]), "id_code", "YEAR") == [("a", "2016"), ("b", "2017")]
    assert values(readers.read_yearly(spark, str(tmp_path), "i1"), "id_code", "YEAR") == [("a", "2016"), ("b", "2017")]
    put(tmp_path / "c_i1.csv", ["YEAR", "other"], [(2018, "c")])
    with pytest.raises(ValueError, match="c_i1.csv.*other"):
        readers.read_yearly(spark, str(tmp_path), "i1")
    with pytest.raises(ValueError):
        readers.read_yearly(spark, str(tmp_path), "i9")


def test_quoted_text_and_malformed_rows(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b,c\n1,"x ""y"", z",k\n2,"two\nlines",k\n3,surplus,k,l\n')
    assert values(readers.read_raw(spark, str(path)).filter("a = '1'")) == [("1", 'x "y", z', "k")]
    whole = readers.read_raw(spark, str(path), multi_line=True)
    assert values(whole.filter("a = '2'")) == [("2", "two\nlines", "k")] and whole.count() == 3
    assert values(readers.malformed_rows(spark, str(path), multiLine="true")) == [("q.csv", 3, 1)]
    assert values(readers.malformed_rows(spark, str(path))) == [("q.csv", 4, 3)]
    df = spark.createDataFrame([('x "y", z', "a"), ('"', None)], "x string, y string")
    back = writers.write_table(df, str(tmp_path / "t"), "csv")
    assert values(back) == values(df) == values(readers.read_raw(spark, str(tmp_path / "t")))


def test_files_of_a_partitioned_table(spark, tmp_path):
    df = spark.range(0, 40_000, 1, 16).selectExpr("id", "cast(2004 + id % 19 as string) as year")
    back = writers.write_table(df, str(tmp_path / "t"), partition_by=["year"])
    assert back.count() == 40_000
    files = list((tmp_path / "t").glob("year=*/*.parquet"))
    assert len(files) <= 2 * 19


def test_parts_and_holes(spark, tmp_path):
    square = lambda x, y, d: [(x, y), (x + d, y), (x + d, y + d), (x, y + d)]
    rings = [square(0.0, 0.0, 10.0), square(20.0, 0.0, 5.0), square(2.0, 2.0, 3.0), square(3.0, 3.0, 1.0)]
    layer = spark.createDataFrame([("A", rings, 7)], "NM_INDEX string, rings array<array<struct<x: double, y: double>>>, n int")
    writers.write_layer(layer, str(tmp_path / "l"))
    feature = json.loads(spark.read.text(str(tmp_path / "l")).first()[0])
    parts = feature["geometry"]["coordinates"]
    assert feature["geometry"]["type"] == "MultiPolygon" and feature["properties"] == {"NM_INDEX": "A", "n": 7}
    assert sorted(len(p) for p in parts) == [1, 1, 2]  # the island in the hole is a part of its own
    assert all(ring[0] == ring[-1] and len(ring) == 5 for part in parts for ring in part)
    back = readers.read_polygons(spark, str(tmp_path / "l")).first()["rings"]
    assert sorted(tuple((p.x, p.y) for p in ring) for ring in back) == sorted(map(tuple, rings))


def test_many_rings_in_one_feature(spark, tmp_path):
    """2,000 rings: squares in a row, each with a hole, an island in it and a hole in that."""
    square = lambda x, d: [(x - d, -d), (x + d, -d), (x + d, d), (x - d, d)]
    rings = [square(100.0 * i, d) for i in range(500) for d in (1.0, 8.0, 2.0, 4.0)]
    layer = spark.createDataFrame([("A", rings)], "NM_INDEX string, rings array<array<struct<x: double, y: double>>>")
    start = time.time()
    parts = writers.with_parts(layer).first()["parts"]
    assert time.time() - start < 30
    widths = sorted([tuple(ring[1].x - ring[0].x for ring in part) for part in parts])
    assert widths == [(4.0, 2.0)] * 500 + [(16.0, 8.0)] * 500
    assert all(part[0][0].x < part[1][0].x < part[0][1].x for part in parts)


def jobs_of(spark, run):
    """How many jobs an action starts."""
    context, group = spark.sparkContext, f"jobs-{time.time_ns()}"
    context.setJobGroup(group, "counted")
    out = run()
    found = len(context.statusTracker().getJobIdsForGroup(group))
    context.setLocalProperty("spark.jobGroup.id", None)
    return out, found


def test_headers_in_one_job(spark, tmp_path):
    few, many = tmp_path / "few", tmp_path / "many"
    for folder, n in ((few, 2), (many, 40)):
        folder.mkdir()
        for i in range(n):
            put(folder / f"f{i:02d}_i1.csv", ["id_code", "YEAR"] if i % 2 else [" YEAR ", "id_code"], [(f"{i}", 2016)])
    held = spark.conf.get("spark.sql.files.openCostInBytes")
    one, jobs_few = jobs_of(spark, lambda: readers.find_headers(spark, str(few), ["i1"]))
    two, jobs_many = jobs_of(spark, lambda: readers.find_headers(spark, str(many), ["i1"]))
    assert jobs_few == jobs_many and spark.conf.get("spark.sql.files.openCostInBytes") == held
    assert {h: len(f) for h, f in two["i1"].items()} == {("YEAR", "id_code"): 20, ("id_code", "YEAR"): 20}
    assert readers.read_raw(spark, str(many)).filter("YEAR = '2016'").count() == 20


def test_unclear_first_lines(spark, tmp_path):
    """Blank first lines, headers over two lines, empty and large files: each file has its own header."""
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "a_i1.csv").write_text("\na,b\n1,2\n")
    (folder / "b_i1.csv").write_text("\nc,d\n3,4\n")
    (folder / "c_i1.csv").write_text("")
    (folder / "d_i1.csv").write_text('"x\ny",e\n5,6\n')
    (folder / "e_i1.csv").write_text('"x\nz",e\n7,8\n')
    put(folder / "f_i1.csv", ["g"], [(i,) for i in range(1000)])
    found = readers.find_headers(spark, str(folder), ["i1"], multiLine=True)["i1"]
    assert {h: len(f) for h, f in found.items()} == {("a", "b"): 1, ("c", "d"): 1, ("x\ny", "e"): 1, ("x\nz", "e"): 1, ("g",): 1}


@pytest.mark.parametrize("keys", [["k"], ["name", "k"]])
def test_sorted_table(spark, tmp_path, keys):
    """Small pieces are left apart here, so that there are several files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(20_000).selectExpr("(id * 7919) % 20011 as k", "if(id % 50 = 0, null, md5(cast(id % 9 as string))) as name")
    back = writers.write_table(rows.repartition(6), str(tmp_path / "sorted"), sort_by=keys)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted((r.f, r.rows) for r in back.groupBy(F.input_file_name().alias("f")).agg(F.collect_list(F.struct(*keys)).alias("rows")).collect())
    in_order = [tuple((v is not None, v) for v in row) for _, part in files for row in part]
    assert len(files) > 1 and len(in_order) == 20_000
    assert all(a <= b for a, b in zip(in_order, in_order[1:]))


def test_stages_are_removed(spark):
    first, second = session.stage_table(spark.range(3).toDF("n"), "gone"), session.stage_table(spark.range(4).toDF("n"), "stays")
    assert session.drop_stages(spark, first) == 1 and second.count() == 4
    with pytest.raises(Exception):  # noqa: B017, PT011
        first.count()


def test_lookups(spark, tmp_path):
    path = put(tmp_path / "species.csv", ["PSMFC_Code", "ALPHA5", "Common_Name", "TripType_Description"], SPECIES)
    names = values(readers.read_species(spark, path), "Common_Name")
    assert ("lingcod",) in names and ("bivalve class",) not in names
    path = put(tmp_path / "groups.csv", ["Common_Name_catch", "Rockfish", "Flat fish"], [("bocaccio", 1, 0), ("halibut", 0, 1)])
    groups = readers.read_groups(spark, path)
    assert species.group_names(groups) == ["Rockfish", "Flat fish"]
    assert values(species.group_members(groups)) == [("bocaccio", "Rockfish"), ("halibut", "Flat fish")]


def test_polygon_features(spark, tmp_path):
    path = tmp_path / "blocks.geojsonl"
    path.write_text(
        '{"type":"Feature","properties":{"NM_INDEX":"A","z":1},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}\n'
        '{"type":"Feature","properties":{"NM_INDEX":"B"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1]]],[[[5,5],[6,5],[6,6]],[[5.2,5.1],[5.3,5.1],[5.3,5.2]]]]}}\n'
        '{"type":"Feature","properties":{"NM_INDEX":"C"},"geometry":null}\n'
    )
    layer = readers.read_polygons(spark, str(path))
    assert values(layer.select("NM_INDEX", F.size("rings"), F.expr("rings[0][1].x"))) == [("A", 1, 1.0), ("B", 3, 1.0)]
    writers.write_table(layer, str(tmp_path / "p"))
    assert readers.read_polygons(spark, str(tmp_path / "p"), file_format="parquet").count() == 2
    turned = readers.read_polygons(spark, str(path), projected=True)
    assert turned.first()["rings"][0][0]["x"] == pytest.approx(-120)


def test_text_table_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.5), (None, "b", None)], "x string, y string, n double")
    back = writers.write_table(df, str(tmp_path / "t"), "csv")
    assert values(back) == values(df)
    assert readers.read_stage(spark, str(tmp_path / "t"), "csv").filter("x is null").count() == 1
    assert writers.layer_name("blue rockfish", "All", 3, "long") == "blue_rockfish_All_3_SAMPLES_long"


class FakeSession:
    """Just what `shared_dir` asks of a session."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})


def test_shared_folder(spark, tmp_path):
    assert session.shared_dir(FakeSession("yarn", "hdfs://here")) == "hdfs://here"
    with pytest.raises(ValueError):
        session.shared_dir(FakeSession("yarn", None))
    local = session.shared_dir(FakeSession("local[2]", None))
    assert local.startswith("/tmp/") and session.shared_dir(FakeSession("local[2]", None)) == local
    assert session.stage_table(spark.range(5).toDF("n"), "five", str(tmp_path)).count() == 5
    assert [p.name[:5] for p in tmp_path.iterdir()] == ["five-"]


def test_rebuild(spark, tmp_path):
    def id_code(n, year=2012):
        return f"1234{n}{year}0601001"

    def frame(columns, *rows):
        return text_frame(spark, columns, [[r.get(c) for c in columns] for r in rows])

    new_i1 = ["id" if c == "ID" else ("daysf" if c == "DAYSF" else c) for c in I1]
    spot = {"YEAR": "2012", "MODE_FX": "7"}
    forms = {"YEAR": "2012", "prim1": "8827010201", "CNTRBTRS": "2", "DAYSF": "1"}
    fish = {"YEAR": "2012", "SP_CODE": "8827010201"}
    raw = text_frame(spark, ["PSMFC_Code", "ALPHA5", "Common_Name", "TripType_Description"], SPECIES)
    survey = Survey(
        i1_old=frame(I1, {"ID_CODE": id_code(1), "FIRST": "1", **forms}, {"ID_CODE": id_code(2), "LEADER": id_code(1), **forms},
                     {"ID_CODE": id_code(3), "survey": "PR1", **forms}),
        i1_new=frame(new_i1, {"ID_CODE": id_code(4, 2018), "YEAR": "2018", "prim1": "8857030309", "CNTRBTRS": "1", "daysf": "2", "survey": "PR1"}),
        i2_old=frame(I2, {"ID_CODE": id_code(3), "DISPO": "3", "NUM_FISH": "4", **fish}, {"ID_CODE": id_code(3), "DISPO": "3", "NUM_FISH": "4", **fish}),
        i2_new=frame(I2 + ["assnid"], {"ID_CODE": id_code(9), "DISPO": "1", "NUM_FISH": "1", **fish}),
        i3_old=frame(I3, {"ID_CODE": id_code(2), "WGT": "1.5", "FSHINSP": "6", **fish}, {"ID_CODE": id_code(3), "WGT": "WGT", "FSHINSP": "1", **fish}),
        i3_new=frame(I3 + ["assnid"], {"ID_CODE": id_code(4, 2018), "YEAR": "2018", "SP_CODE": "8857030309", "FSHINSP": "2"}),
        i8_old_north=frame(I8, {"ID_CODE": id_code(1), "block1": "1035", **spot}, {"ID_CODE": id_code(2), "block1": "1035", "block2": "1036", **spot},
                           {"ID_CODE": id_code(8), "YEAR": "2016", "MODE_FX": "7", "block1": "1035"},
                           {"ID_CODE": id_code(9), "MODE_FX": "7", "block1": "1035"}),
        i8_old_south=frame(I8, {"ID_CODE": id_code(3), "ddlat": "36.5", "ddlong": "122.5", **spot}),
        i8_new=frame(["id_code" if c == "ID_CODE" else c for c in I8], {"id_code": id_code(4, 2018), "YEAR": "2018", "MODE_FX": "7", "block1": "1035"}),
        species=species.clean_species(raw),
        polygons=polygons(spark),
    )
    tables = rebuild(spark, survey, str(tmp_path))
    assert values(tables["all_by_id"], "id", "year", "Block", "Total_Fish_Caught", "AnglerDays") == [
        (f"ID{id_code(1)}1", "2012", "1035-", 3.0, 4.0),
        (f"ID{id_code(3)}1", "2012", "A", 5.0, 2.0),
        (f"ID{id_code(4, 2018)}1", "2018", "1035-", 2.0, 2.0),
    ]
    # the follower's catch in a block its leader did not report has no effort
    assert values(tables["all_by_id_notused"], "Block", REASON) == [("1036-", R.CATCH_NO_EFFORT)]
    assert values(tables["blocks_off_map"], "Block", "n") == [("1035-", 2)]
    assert values(tables["blocks_off_map_rows"], "Block", REASON) == [("1035-", R.BLOCK_OFF_MAP)] * 2
    for stage in ("location", "oc", "rc", "oe", "all_by_id"):
        assert tables[f"{stage}_reconciled"].first()["balanced"], stage
    assert values(tables["schema_differences"]) == sorted(
        [("i1", "DAYSF", "old"), ("i1", "daysf", "new"), ("i2", "assnid", "new"), ("i3", "assnid", "new"),
         ("i8", "ID_CODE", "old"), ("i8", "id_code", "new")], key=repr)
    replaced = tables["location_cleaned_notused"].filter(F.col(REASON).isin(R.LOCATION_REPLACED, R.LOCATION_NO_YEAR))
    assert values(replaced, "ID_CODE", REASON) == [(id_code(8), R.LOCATION_REPLACED), (id_code(9), R.LOCATION_NO_YEAR)]
    assert tables["leader_fan_out"].isEmpty() and tables["effort_without_catch"].columns[0] == "id"
    counts = {r[REASON]: r["Count"] for r in tables["rc_notused_summary"].collect()}
    assert counts[R.NO_LOCATION] == 1 and sum(counts.values()) == 1
    assert tables["location_duplicate_rate"].first() == (4, 1, 0.0)
    assert tables["location_duplicates"].isEmpty() and tables["leader_duplicates"].isEmpty()
    assert values(tables["target_types"]) == [("Bottomfish", 2), ("Inshore", 1)]
    assert values(tables["location_range_sizes"], "n") == [(4,)]
    for name in ("location_cleaned_wide", "combos", "outliers_weight", "oc_duplicates", "oe_notused_by_year", "screened_locations"):
        assert (tmp_path / name).exists()
    assert values(spark.read.parquet(str(tmp_path / "oe")), "id_noloc", "AnglerDays")[0] == (f"ID{id_code(1)}", 4.0)
