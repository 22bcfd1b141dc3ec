"""Hot keys: results stay whole and AQE splits the hot partition."""

import pytest
from pyspark.sql import functions as F

from creelgrid import session
from creelgrid.operators import catch, dedupe, joins, layers, locations, outliers, rejects, reshape, spatial

from conftest import values


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=200_000):
    """A third of the rows under key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_key_is_split(spark, no_broadcast, how):
    rows = hot(spark)
    sizes = dedupe.group_sizes(rows, ["k"])
    right = sizes.filter("n = 1") if how == "left_anti" else sizes
    joined = joins.skew_join(rows, right.select("k") if "semi" in how or "anti" in how else right, ["k"], how)
    plan = final_plan(joined)
    assert "skew=true" in plan or "skewed" in plan
    assert joined.count() == (66_667 if how == "left_anti" else 200_000)


def test_group_size_of_hot_key(spark, no_broadcast):
    sized = dedupe.with_group_size(hot(spark), ["k"])
    assert sized.filter("k = 0").select("n").distinct().collect() == [(66_667,)]
    assert sized.count() == 200_000


def test_ambiguous_hot_key(spark, no_broadcast):
    stage = dedupe.drop_ambiguous(hot(spark), ["k"], "again")
    assert stage.kept.count() == 133_333
    assert stage.rejects.count() == 66_667
    assert "skew" in final_plan(stage.rejects)


def test_hot_location_id_merges(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id_loc"),
        F.lit("2012").alias("year"),
        (F.col("id") % 40).cast("string").alias("Block"),
    )
    stage = dedupe.consolidate_blocks(rows, "id_loc", ["year"])
    assert stage.kept.filter("id_loc = 'hot'").count() == 40
    assert stage.kept.filter("id_loc = 'hot'").first()["total_blocks"] == 40
    assert stage.kept.count() == 40_040
    clash = rows.unionByName(rows.limit(1).withColumns({"id_loc": F.lit("hot"), "year": F.lit("2013")}))
    stage = dedupe.consolidate_blocks(clash, "id_loc", ["year"])
    assert stage.kept.filter("id_loc = 'hot'").isEmpty()
    assert values(stage.rejects, "id_loc", "year") == [("hot", "2012"), ("hot", "2013")]


def test_no_window_over_raw_rows(spark):
    """Windows come only after an aggregation; nothing is gathered into lists."""
    rows = hot(spark).withColumnsRenamed({"k": "id_loc", "v": "Block"})
    plans = [
        dedupe.consolidate_blocks(rows, "id_loc", ["payload"]).kept,
        dedupe.with_group_size(rows, ["id_loc"]),
        outliers.with_zscore(rows, "Block", "id_loc", "z"),
    ]
    for df in plans:
        text = df._jdf.queryExecution().optimizedPlan().toString()
        window = text.find("Window [")
        assert window < 0 or "Aggregate [" in text[window:]
        assert "collect_list" not in text and "collect_set" not in text


def test_hot_grid_cell(spark, no_broadcast):
    points = spark.range(60_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") % 100 + 0.5).alias("lon"),
        F.lit(0.5).alias("lat"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    squares = spark.range(100).selectExpr(
        "cast(id as string) as NM_INDEX",
        "array(array(named_struct('x', double(id), 'y', 0D), named_struct('x', id + 1D, 'y', 0D), "
        "named_struct('x', id + 1D, 'y', 1D), named_struct('x', double(id), 'y', 1D))) as rings",
    )
    located = spatial.locate_points(points, squares)
    assert located.filter("NM_INDEX is null").isEmpty()
    assert located.count() == 60_000
    plan = final_plan(located)
    assert "skew" in plan and "Nested" not in plan and "Cartesian" not in plan


def test_null_keys(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, "b", "y")], "k int, b string, v string")
    b = spark.createDataFrame([(1, None, "p"), (None, "b", "q"), (2, "c", "r")], "k int, b string, v string")
    assert values(joins.full_join(a, b, ["k", "b"], ("_l", "_r"))) == [
        (1, None, "x", "p"), (2, "c", None, "r"), (None, "b", "y", "q"),
    ]
    assert joins.anti_all_columns(a, a).isEmpty()
    assert joins.anti_all_columns(a.unionAll(a), b).count() == 4
    assert values(joins.natural_left_join(a, b.withColumnRenamed("v", "w")), "v", "w") == [("x", "p"), ("y", "q")]


@pytest.mark.parametrize("side", ["left", "right"])
def test_full_join_splits_a_hot_key(spark, no_broadcast, side):
    rows, few = hot(spark, 120_000), spark.range(60_000, 180_000).selectExpr("if(id = 60000, 0, id) as k", "id as w")
    a, b = (rows, few) if side == "left" else (few, rows)
    a, b = session.stage_table(a, "full_a"), session.stage_table(b, "full_b")
    joined = joins.full_join(a, b, ["k"])
    plan = final_plan(joined)
    assert "skew=true" in plan and "FullOuter" not in plan
    want = a.join(b, "k", "full")
    assert joined.count() == want.count() and joined.exceptAll(want.select(joined.columns)).isEmpty()


def test_full_join_with_some_null_safe_keys(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, "b", "y"), (3, "c", "z")], "k int, b string, v string")
    b = spark.createDataFrame([(1, None, "p"), (None, "b", "q"), (4, None, "r")], "j int, b string, w string")
    got = values(joins.full_join(a, b, [("k", "j"), "b"], null_safe=["b"]))
    want = a.join(b, (a.k == b.j) & a.b.eqNullSafe(b.b), "full").select(F.coalesce("k", "j"), F.coalesce(a.b, b.b), "v", "w")
    assert got == values(want) and len(got) == 5


def test_repeated_keys_without_sorting_rows(spark, no_broadcast):
    rows = session.stage_table(hot(spark, 60_000), "raw")
    stage = dedupe.drop_ambiguous(rows, ["k"], "again")
    for frame in (stage.kept, stage.rejects):
        assert "SortAggregate" not in final_plan(frame)
    placed = rows.selectExpr("k", "'x' as mode", "cast(v % 5 as string) as Block")
    merged = dedupe.consolidate_blocks(placed, "k", ["mode"])
    assert "SortAggregate" not in final_plan(merged.kept) and "SortAggregate" not in final_plan(merged.rejects)
    assert merged.kept.filter("k = 0").select("total_blocks").distinct().collect() == [(5,)]


def test_conflicting_rows_of_one_location(spark):
    rows = [("a", "m", "1"), ("a", "m", "2"), ("a", "m", "2"), ("b", "m", "1"), ("b", None, "1"), ("c", None, "3"), (None, "m", "4"), (None, "n", "4")]
    stage = dedupe.consolidate_blocks(spark.createDataFrame(rows, "k string, mode string, Block string"), "k", ["mode"])
    assert values(stage.kept, "k", "mode", "Block", "total_blocks") == [("a", "m", "1", 2), ("a", "m", "2", 2), ("c", None, "3", 1)]
    assert values(stage.rejects, "k", "mode") == [("b", "m"), ("b", None), (None, "m"), (None, "n")]


def test_members(spark):
    a = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    b = spark.createDataFrame([(1,), (None,)], "v int")
    assert values(joins.rows_in(a, "v", b)) == [(1,), (None,)]
    assert values(joins.rows_not_in(a, "v", b)) == [(3,)]
    assert values(joins.rows_not_in(a, "v", b.filter("v = 1"))) == [(3,), (None,)]


def test_join_audit(spark):
    before = spark.createDataFrame([("a",), ("a",), ("b",)], "id string").withColumn("year", F.lit(1))
    after = before.unionAll(before.filter("id = 'b'"))
    assert values(joins.join_audit(before, after, "id", ["year"])) == [("b", 1, 2, 1)]


def test_reject_rules(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50), (4, 7)], "k int, v int")
    rules = [("none", F.col("v").isNull()), ([("big", F.col("v") > 9), ("odd", F.col("v") % 2 == 1)], F.col("k") < 4)]
    stage = rejects.split_rejects(df, rules)
    assert values(stage.rejects, "k", "Reason") == [(1, "none"), (2, "odd"), (3, "big")]
    assert values(stage.kept) == [(4, 7)]
    assert stage.reasons == ("none", "big", "odd")
    assert values(rejects.reject_summary(stage.rejects, ("none", "never"))) == [("never", 0), ("none", 1)]
    assert rejects.reconcile(df, stage.kept, stage.rejects).first() == (4, 4, True)
    assert rejects.reconcile(df, stage.kept).first() == (4, 1, False)


def test_reshaping(spark):
    df = spark.createDataFrame([("a", "x", None, None), ("b", None, "y", None)], "k string, b1 string, b2 string, b3 string")
    assert reshape.drop_all_null(df).columns == ["k", "b1", "b2"]
    assert values(reshape.blocks_to_rows(df, ["b1", "b2", "b3"])) == [("a", "x"), ("b", "y")]
    assert reshape.schema_difference(df, df.drop("b1").withColumn("z", F.lit(1))) == (["b1"], ["z"])
    assert reshape.present_of(df, ["b2", "q"]) == ["b2"]
    assert reshape.named_first(df, "b2").columns == ["b2", "k", "b1", "b3"]
    assert reshape.align_to(df, df.select("b2", "k")).columns == ["b2", "k"]
    with pytest.raises(Exception):
        reshape.union_strict(df, df.drop("b1")).collect()
    filled = reshape.fill_no_data(spark.createDataFrame([(None, None)], "n double, t string"))
    assert filled.first() == (-9999.0, "-9999")
    assert reshape.map_columns(df, ["b1"], lambda c: F.coalesce(c, F.lit("-"))).filter("b1 = '-'").count() == 1


def test_constant_group_has_no_zscore(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 3.0), (None, 1.0), (None, 2.0), (None, 9.0)], "g string, x double")
    scored = {(r["g"], r["x"]): r["z"] for r in outliers.with_zscore(df, "x", "g", "z").collect()}
    assert scored[("a", 1.0)] is None and scored[("b", 3.0)] is None
    assert scored[(None, 9.0)] == pytest.approx(1.147, abs=1e-3)


def test_dup_rate(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    assert dedupe.dup_rate(df, "k").first() == (3, 2, 33.33)
