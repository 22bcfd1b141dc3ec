"""One query per operator, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creelgrid import reasons as R
from creelgrid.functions import scalars as X
from creelgrid.operators import assemble as asm
from creelgrid.operators import catch, dedupe, effort, joins, layers, locations, outliers, party, rejects, reshape
from creelgrid.operators import spatial, species
from creelgrid.operators.rejects import in_plan
from creelgrid.session import configure, shared_dir, stage_table
from creelgrid.sources import readers, writers

from . import casting
from .casting import load, survey
from .oracle import albers_sql, blank, code, lit, num, rnd, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def probe(name: str, select: str | None):
    """Register a query and the SELECT that must give the same rows."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), str(sf_dir))

        QUERIES[name] = run
        if select is not None:
            ORACLES[name] = sql(select)
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Floating sums depend on their order; compare six digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


# Stage tables, written once per session as the rebuild does.

_stages: dict[tuple[str, str, str], DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        _stages[key] = stage_table(STAGES[name](spark, sf_dir).kept, name)
    return _stages[key]


def species_of(spark, sf_dir):
    return species.clean_species(survey(spark, sf_dir, "species_raw"))


def leaders_of(spark, sf_dir):
    return party.leader_map(effort.effort_rows(survey(spark, sf_dir, "i1")))


def location_stage(spark, sf_dir, keep=in_plan):
    stacked = locations.stack_locations(*casting.location_files(spark, sf_dir))
    return locations.clean_locations(stacked, casting.blocks(spark, sf_dir), keep=keep)


def observed_stage(spark, sf_dir, keep=in_plan):
    return catch.observed_catch(
        survey(spark, sf_dir, "i3"), stage(spark, sf_dir, "locations"), species_of(spark, sf_dir), leaders_of(spark, sf_dir), keep
    )


def reported_stage(spark, sf_dir, keep=in_plan):
    return catch.reported_catch(
        survey(spark, sf_dir, "i2"), stage(spark, sf_dir, "locations"), species_of(spark, sf_dir), leaders_of(spark, sf_dir), keep
    )


def effort_stage(spark, sf_dir, keep=in_plan):
    return effort.effort(survey(spark, sf_dir, "i1"), stage(spark, sf_dir, "locations"), species_of(spark, sf_dir), keep)


def assemble_stage(spark, sf_dir, keep=in_plan):
    return asm.assemble(stage(spark, sf_dir, "oc"), stage(spark, sf_dir, "rc"), stage(spark, sf_dir, "oe"), keep)


STAGES = {
    "locations": location_stage,
    "oc": observed_stage,
    "rc": reported_stage,
    "oe": effort_stage,
    "all_by_id": assemble_stage,
}


# Scalars


@probe(
    "block_code",
    f"""select id_loc, {code('block1', 'box1a')} as code1, {code('block2', 'box2a')} as code2,
               (select count(distinct v) from (values (c1), (c2), (c3), (c4), (c5), (c6)) t(v)) as codes
        from i8_plain""",
)
def block_code(spark, sf_dir):
    i8 = survey(spark, sf_dir, "i8")
    text = i8.select(
        X.trip_location_id("ID_CODE", X.default_locn("locn")).alias("id_loc"),
        X.sentinel_to_null(X.strip_zeros("block1"), X.BLOCK_SENTINEL).alias("block1"),
        *[X.strip_zeros(c).alias(c) for c in ("block2", "box1a", "box1b", "box1c", "box2a", "box2b", "box2c")],
    )
    pairs = [(b, f"box{b[-1]}{x}") for b in ("block1", "block2") for x in "abc"]
    return text.select(
        "id_loc",
        X.format_box("block1", "box1a").alias("code1"),
        X.format_box("block2", "box2a").alias("code2"),
        X.distinct_given(*[X.format_box(b, x) for b, x in pairs]).cast("bigint").alias("codes"),
    )


@probe(
    "id_date_month",
    """select id, strftime(day, '%Y-%m-%d') as day, cast(month(day) as int) as month,
              '19' || lpad(cast(month(day) as varchar), 2, '0') as label, 'ID' || id as published_id
       from (select id, cast(try_strptime(substr(id, 6, 8), '%Y%m%d') as date) as day
             from (select case when l_linenumber = 7 then concat('99999', '20041345', ID_CODE) else ID_CODE end as id
                   from (select concat(cast(10000 + l_orderkey % 90000 as varchar),
                                strftime(date '2004-01-01' + cast(l_orderkey % 6900 as int), '%Y%m%d'),
                                cast(cast(floor(l_orderkey / 90000) as bigint) as varchar)) as ID_CODE, l_linenumber
                         from lineitem) a) b) c""",
)
def id_date_month(spark, sf_dir):
    own = F.expr(casting.id_code("l_orderkey", "spark"))
    bad = F.concat(F.lit("9999920041345"), own)
    ids = load(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") == 7, bad).otherwise(own).alias("id"))
    dated = ids.select("id", X.id_date("id").alias("date"), X.id_month(X.prefixed("id"), is_prefixed=True).alias("month"))
    return dated.select(
        "id",
        F.date_format("date", "yyyy-MM-dd").alias("day"),
        "month",
        X.month_label("month").alias("label"),
        X.prefixed("id").alias("published_id"),
    )


_MIXED = """case l_linenumber when 1 then concat(' ', cast(l_partkey as varchar(20)), ' ') when 2 then '.'
            when 3 then concat(cast(l_partkey as varchar(20)), 'd') when 4 then concat('-', cast(l_suppkey as varchar(20)), '.25')
            when 5 then '1e3' when 6 then 'NaN' else '' end"""


@probe(
    "text_to_number",
    f"select k, text, {num('text')} as number from (select l_orderkey as k, {blank('mixed')} as text "
    f"from (select l_orderkey, {_MIXED} as mixed from lineitem) a) b",
)
def text_to_number(spark, sf_dir):
    text = load(spark, sf_dir, "lineitem").selectExpr("l_orderkey as k", f"{_MIXED} as mixed")
    return text.select("k", X.blank_to_null("mixed", X.NULL_TOKENS).alias("text")).withColumn("number", X.to_number("text"))


# Screens and audits


def _tagged(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "cast(year(l_shipdate) as varchar(4)) as year",
        "nullif(l_suppkey % 7, 3) as side",
    )
    return rejects.split_rejects(
        lines,
        [
            ("no side", F.col("side").isNull()),
            ([("low part", F.col("l_partkey") % 5 == 0), ("low line", F.col("l_linenumber") < 2)], F.col("side") < 4),
            ("never", F.col("side") > 10),
        ],
    )


_TAGGED = """(select l_orderkey, l_partkey, l_linenumber, cast(year(l_shipdate) as varchar) as year,
              nullif(l_suppkey % 7, 3) as side,
              case when l_suppkey % 7 = 3 then 'no side' when l_suppkey % 7 < 4 and l_partkey % 5 = 0 then 'low part'
                   when l_suppkey % 7 < 4 and l_linenumber < 2 then 'low line' end as Reason from lineitem) t"""


@probe("reject_split", f"select * from {_TAGGED} where Reason is not null")
def reject_split(spark, sf_dir):
    return _tagged(spark, sf_dir).rejects


@probe("reject_kept", f"select * exclude (Reason) from {_TAGGED} where Reason is null")
def reject_kept(spark, sf_dir):
    return _tagged(spark, sf_dir).kept


@probe(
    "reject_summary",
    f"""select r.Reason, count(t.Reason) as "Count" from (values ('no side'), ('low part'), ('low line'), ('never')) r(Reason)
        left join {_TAGGED} on r.Reason = t.Reason group by 1""",
)
def reject_summary(spark, sf_dir):
    return _tagged(spark, sf_dir).summary()


@probe(
    "by_year_audit",
    f"select Reason, year, l_linenumber, count(*) as n from {_TAGGED} where Reason is not null group by 1, 2, 3",
)
def by_year_audit(spark, sf_dir):
    return rejects.by_year_audit(_tagged(spark, sf_dir).rejects, "l_linenumber")


@probe(
    "reconcile",
    "select count(*) as rows_before, count(*) as rows_after, true as balanced from lineitem",
)
def reconcile(spark, sf_dir):
    split = _tagged(spark, sf_dir)
    return rejects.reconcile(load(spark, sf_dir, "lineitem"), split.kept, split.rejects)


@probe("dup_audit", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def dup_audit(spark, sf_dir):
    return dedupe.dup_audit(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@probe(
    "dup_rate",
    f"""select count(*) as ids, max(n) as max_rows, {rnd('avg(case when n > 1 then 100.0 else 0.0 end)', 2)} as percent_duplicated
        from (select l_orderkey, count(*) as n from lineitem group by 1) g""",
)
def dup_rate(spark, sf_dir):
    return dedupe.dup_rate(load(spark, sf_dir, "lineitem"), "l_orderkey")


@probe(
    "join_audit",
    """with b as (select l_orderkey, count(*) as n_before from lineitem group by 1),
            a as (select l_orderkey, cast(year(l_shipdate) as int) as year, count(*) as n_after from lineitem
                  join part on l_partkey = p_partkey where p_size > 10 group by 1, 2)
       select l_orderkey, year, n_after, n_before from a join b using (l_orderkey) where n_after <> n_before""",
)
def join_audit(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.year("l_shipdate").alias("year"))
    parts = load(spark, sf_dir, "part").filter("p_size > 10").select("p_partkey")
    after = joins.keyed_join(lines, parts, [("l_partkey", "p_partkey")])
    return joins.join_audit(lines, after, "l_orderkey", ["year"])


# Unions, distinct, reshaping


@probe(
    "union_by_name",
    """select ID_CODE, cast(YEAR as int) as y, CNTRBTRS, DAYSF, case when cast(YEAR as int) < 2016 then LEADER end as LEADER
       from i1""",
)
def union_by_name(spark, sf_dir):
    i1 = survey(spark, sf_dir, "i1")
    old = i1.filter("cast(YEAR as int) < 2016").select("ID_CODE", "YEAR", "CNTRBTRS", "DAYSF", "LEADER")
    new = i1.filter("cast(YEAR as int) >= 2016").select("DAYSF", "CNTRBTRS", "YEAR", "ID_CODE").withColumnRenamed("DAYSF", "daysf")
    return effort.stack_effort(old, new).selectExpr("ID_CODE", "cast(YEAR as int) as y", "CNTRBTRS", "DAYSF", "LEADER")


@probe(
    "stack_locations",
    f"select ID_CODE, {blank('locn')} as locn, YEAR, block1, survey, stack_reason from i8_stacked",
)
def stack_locations(spark, sf_dir):
    stacked = locations.stack_locations(*casting.location_files(spark, sf_dir))
    return stacked.select("ID_CODE", "locn", "YEAR", "block1", "survey", "stack_reason")


@probe("distinct_rows", "select distinct l_orderkey, l_linenumber, nullif(l_suppkey % 3, 1) as s from lineitem")
def distinct_rows(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "nullif(l_suppkey % 3, 1) as s").distinct()


@probe(
    "drop_all_null",
    "select "
    + ", ".join(f"{blank(c)} as {c}" for c in ("ID_CODE", "locn", "YEAR", "MODE_FX", "survey", "ddlat", "ddlong", "block1"))
    + ", "
    + ", ".join(f"{blank(c)} as {c}" for c in ("box1a", "box1b", "block2", "box2a", "HGSIZE", "hgsize2"))
    + " from i8",
)
def drop_all_null(spark, sf_dir):
    return reshape.drop_all_null(survey(spark, sf_dir, "i8"))


@probe(
    "explode_blocks",
    """select l_orderkey, Block from (
         select l_orderkey, nullif(l_suppkey % 10, 3) as Block from lineitem
         union all select l_orderkey, nullif(l_partkey % 10, 4) from lineitem
         union all select l_orderkey, nullif(cast(l_linenumber as bigint), 7) from lineitem) u where Block is not null""",
)
def explode_blocks(spark, sf_dir):
    wide = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "nullif(l_suppkey % 10, 3) as b1", "nullif(l_partkey % 10, 4) as b2",
        "nullif(cast(l_linenumber as bigint), 7) as b3",
    )
    return reshape.blocks_to_rows(wide, ["b1", "b2", "b3"])


@probe(
    "block_slots",
    """select id_loc, year, ID_CODE, MODE_FX, survey, total_blocks, """
    + ", ".join(f"b[{i + 1}] as {n}" for i, n in enumerate(reshape.SLOT_NAMES))
    + f""", nullif(array_to_string(b[{len(reshape.SLOT_NAMES) + 1}:], ';'), '') as more_blocks
         from (select id_loc, year, ID_CODE, MODE_FX, survey, total_blocks, list_sort(list(Block)) as b
               from locations group by 1, 2, 3, 4, 5, 6) g""",
)
def block_slots(spark, sf_dir):
    return locations.location_slots(stage(spark, sf_dir, "locations"))


# Joins


@probe(
    "species_inner",
    f"select id, SP_CODE, Common_Name, TripType_Description from (select {blank('ID_CODE')} as id, {num(blank('SP_CODE'))} "
    "as SP_CODE from i2) r join species using (SP_CODE)",
)
def species_inner(spark, sf_dir):
    rows = survey(spark, sf_dir, "i2").select(
        F.col("ID_CODE").alias("id"), X.to_number("SP_CODE").alias("SP_CODE")
    )
    lookup = species_of(spark, sf_dir).select("SP_CODE", "Common_Name", "TripType_Description")
    return joins.keyed_join(rows, lookup, ["SP_CODE"])


@probe(
    "species_anti",
    f"select id, SP_CODE from (select {blank('ID_CODE')} as id, {num(blank('SP_CODE'))} as SP_CODE from i2) r "
    "where not exists (select 1 from species s where s.SP_CODE = r.SP_CODE)",
)
def species_anti(spark, sf_dir):
    rows = survey(spark, sf_dir, "i2").select(
        F.col("ID_CODE").alias("id"), X.to_number("SP_CODE").alias("SP_CODE")
    )
    return joins.skew_join(rows, species_of(spark, sf_dir).select("SP_CODE").distinct(), ["SP_CODE"], "left_anti")


@probe(
    "anti_all_columns",
    """select a, b, c from (select l_orderkey as a, nullif(l_linenumber, 3) as b, l_suppkey % 5 as c from lineitem) l
       where not exists (select 1 from (select o_orderkey as a, nullif(cast(o_custkey % 7 as int), 3) as b, o_custkey % 5 as c
                                        from orders) r
                         where l.a is not distinct from r.a and l.b is not distinct from r.b and l.c is not distinct from r.c)""",
)
def anti_all_columns(spark, sf_dir):
    left = load(spark, sf_dir, "lineitem").selectExpr("l_orderkey as a", "nullif(l_linenumber, 3) as b", "l_suppkey % 5 as c")
    right = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as a", "nullif(cast(o_custkey % 7 as int), 3) as b", "o_custkey % 5 as c"
    )
    return joins.anti_all_columns(left, right)


@probe(
    "membership",
    """select k, n in (1, 2, 6) and n is not null as listed,
              exists (select 1 from (select nullif(s_suppkey, 5) as s from supplier where s_suppkey % 3 = 2) t
                      where t.s is not distinct from l.s) as known
       from (select l_orderkey as k, nullif(l_linenumber, 4) as n, nullif(l_suppkey, 5) as s from lineitem) l""",
)
def membership(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k", "nullif(l_linenumber, 4) as n", "nullif(l_suppkey, 5) as s"
    )
    other = load(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 2").selectExpr("nullif(s_suppkey, 5) as s")
    inside = joins.rows_in(lines, "s", other).withColumn("known", F.lit(True))
    outside = joins.rows_not_in(lines, "s", other).withColumn("known", F.lit(False))
    return inside.unionByName(outside).select("k", X.is_in("n", [1, 2, 6]).alias("listed"), "known")


@probe(
    "known_flag",
    """select l_orderkey as k, l_partkey in (select p_partkey from part where p_size < 20) as known from lineitem""",
)
def known_flag(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr("l_orderkey as k", "l_partkey as p")
    small = load(spark, sf_dir, "part").filter("p_size < 20")
    return joins.flag_known(lines, "p", small, "p_partkey", "known").drop("p")


@probe(
    "full_null_safe",
    """with a as (select nullif(l_orderkey, 10) as k, nullif(l_linenumber, 2) as n, sum(cast(l_quantity as bigint)) as v
                  from lineitem group by 1, 2),
            b as (select nullif(o_orderkey, 10) as k2, nullif(cast(o_custkey % 7 as int), 2) as n, count(*) as v
                  from orders group by 1, 2)
       select coalesce(a.k, b.k2) as k, coalesce(a.n, b.n) as n, cast(a.v as bigint) as v_catch, b.v as v_effort
       from a full join b on a.k is not distinct from b.k2 and a.n is not distinct from b.n""",
)
def full_null_safe(spark, sf_dir):
    a = load(spark, sf_dir, "lineitem").groupBy(
        F.expr("nullif(l_orderkey, 10)").alias("k"), F.expr("nullif(l_linenumber, 2)").alias("n")
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("v"))
    b = load(spark, sf_dir, "orders").groupBy(
        F.expr("nullif(o_orderkey, 10)").alias("k2"), F.expr("nullif(cast(o_custkey % 7 as int), 2)").alias("n")
    ).agg(F.count(F.lit(1)).alias("v"))
    return joins.full_join(a, b, [("k", "k2"), "n"], ("_catch", "_effort"))


@probe(
    "natural_left",
    """with b as (select l_suppkey % 10 as s, nullif(l_linenumber, 2) as n, count(*) as size from lineitem
                  where l_linenumber < 5 group by 1, 2)
       select l.k, l.s, l.n, size from (select l_orderkey as k, l_suppkey % 10 as s, nullif(l_linenumber, 2) as n from lineitem) l
       left join b on l.s is not distinct from b.s and l.n is not distinct from b.n""",
)
def natural_left(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k", "l_suppkey % 10 as s", "nullif(l_linenumber, 2) as n", "l_linenumber"
    )
    sizes = dedupe.group_sizes(lines.filter("l_linenumber < 5"), ["s", "n"], "size")
    return joins.natural_left_join(lines.drop("l_linenumber"), sizes)


# Copies


@probe(
    "group_size",
    """select l_orderkey, l_partkey, s, count(*) over (partition by l_orderkey, s) as n
       from (select l_orderkey, l_partkey, nullif(l_suppkey % 4, 2) as s from lineitem) l""",
)
def group_size(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_partkey", "nullif(l_suppkey % 4, 2) as s")
    return dedupe.with_group_size(lines, ["l_orderkey", "s"])


_AMBIGUOUS = """(select l_orderkey, l_linenumber, l_partkey, l_suppkey,
                 count(*) over (partition by l_orderkey, l_linenumber) as copies from lineitem) c"""


def _ambiguous(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedupe.drop_ambiguous(lines, ["l_orderkey", "l_linenumber"], R.CATCH_AMBIGUOUS)


@probe("drop_ambiguous", f"select * exclude (copies) from {_AMBIGUOUS} where copies = 1")
def drop_ambiguous(spark, sf_dir):
    return _ambiguous(spark, sf_dir).kept


@probe("ambiguous_rejects", f"select * exclude (copies), {lit(R.CATCH_AMBIGUOUS)} as Reason from {_AMBIGUOUS} where copies > 1")
def ambiguous_rejects(spark, sf_dir):
    return _ambiguous(spark, sf_dir).rejects


def _consolidated(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as trip", "nullif(l_suppkey % 17, 4) as survey", "l_linenumber as mode",
        "cast(l_partkey % 50 as varchar(20)) as Block",
    )
    return dedupe.consolidate_blocks(lines.withColumn("trip", F.expr("trip * 10 + mode")), "trip", ["survey", "mode"])


_MERGED = """(select distinct l_orderkey * 10 + l_linenumber as trip, nullif(l_suppkey % 17, 4) as survey,
              l_linenumber as mode from lineitem)"""


@probe(
    "consolidate_blocks",
    f"""select d.*, cast(count(*) over (partition by trip) as int) as total_blocks
        from (select distinct l_orderkey * 10 + l_linenumber as trip, nullif(l_suppkey % 17, 4) as survey,
                     l_linenumber as mode, cast(l_partkey % 50 as varchar) as Block from lineitem) d
        where trip not in (select trip from {_MERGED} m group by 1 having count(*) > 1)""",
)
def consolidate_blocks(spark, sf_dir):
    return _consolidated(spark, sf_dir).kept


@probe(
    "conflicting_ids",
    f"""select m.*, {lit(R.LOCATION_CONFLICT)} as Reason from {_MERGED} m
        where trip in (select trip from {_MERGED} k group by 1 having count(*) > 1)""",
)
def conflicting_ids(spark, sf_dir):
    return _consolidated(spark, sf_dir).rejects


# Space

_POINTS = "(select c_custkey as k, c_custkey * 37 % 1000 as px, c_custkey * 91 % 700 as py from customer) p"
_SHAPES = """(select n_nationkey as n, 'B' || cast(n_nationkey as varchar) as NM_INDEX, n_nationkey * 40 as x0,
              (n_nationkey * 70) % 500 as y0, n_nationkey % 3 as kind from nation) s"""


def _shapes(spark, sf_dir):
    point = "named_struct('x', cast({} as double), 'y', cast({} as double))"

    def ring(*corners):
        return "array({})".format(", ".join(point.format(x, y) for x, y in corners))

    square = ring(("x0", "y0"), ("x0 + 120", "y0"), ("x0 + 120", "y0 + 120"), ("x0", "y0 + 120"))
    hole = ring(("x0 + 30", "y0 + 30"), ("x0 + 90", "y0 + 30"), ("x0 + 90", "y0 + 90"), ("x0 + 30", "y0 + 90"))
    triangle = ring(("x0", "y0"), ("x0 + 120", "y0"), ("x0", "y0 + 120"), ("x0", "y0"))
    flat = load(spark, sf_dir, "nation").selectExpr(
        "concat('B', cast(n_nationkey as varchar(20))) as NM_INDEX", "n_nationkey * 40 as x0",
        "(n_nationkey * 70) % 500 as y0", "n_nationkey % 3 as kind",
    )
    return flat.selectExpr(
        "NM_INDEX", f"case kind when 0 then array({square}) when 1 then array({triangle}) else array({square}, {hole}) end as rings"
    )


@probe(
    "point_in_polygon",
    f"""select k, px, py, NM_INDEX from {_POINTS} left join {_SHAPES}
        on px >= x0 and py >= y0
        and case kind when 1 then (px - x0) + (py - y0) <= 120
            else px <= x0 + 120 and py <= y0 + 120
                 and not (kind = 2 and px > x0 + 30 and px < x0 + 90 and py > y0 + 30 and py < y0 + 90) end""",
)
def point_in_polygon(spark, sf_dir):
    points = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey as k", "c_custkey * 37 % 1000 as px", "c_custkey * 91 % 700 as py"
    )
    exact = points.withColumns({"lon": F.col("px").cast("double"), "lat": F.col("py").cast("double")})
    return spatial.locate_points(exact, _shapes(spark, sf_dir)).drop("lon", "lat")


_X, _Y = "((c_custkey * 7919 % 700000) - 300000.0)", "((c_custkey * 6101 % 1000000) - 600000.0)"
_LON, _LAT = albers_sql(_X, _Y)


@probe("reproject", f"select c_custkey as k, round({_LON}, 6) as lon, round({_LAT}, 6) as lat from customer")
def reproject(spark, sf_dir):
    rings = f"array(array(named_struct('x', cast({_X} as double), 'y', cast({_Y} as double))))"
    polygons = load(spark, sf_dir, "customer").selectExpr("c_custkey as k", f"{rings} as rings")
    turned = spatial.reproject(polygons).select("k", F.inline(F.flatten("rings")))
    return turned.select("k", F.round("x", 6).alias("lon"), F.round("y", 6).alias("lat"))


@probe(
    "attach_blocks",
    """select Block, cast(count(*) as bigint) as trips, x0 as corner
       from (select distinct id_loc, Block from locations) l join blocks_flat on Block = NM_INDEX group by 1, 3""",
)
def attach_blocks(spark, sf_dir):
    counts = dedupe.group_sizes(stage(spark, sf_dir, "locations"), ["Block"], "trips")
    layer = spatial.attach_blocks(counts, casting.blocks(spark, sf_dir))
    return layer.select("Block", "trips", F.expr("rings[0][0].x").alias("corner"))


@probe(
    "unmatched_blocks",
    f"""select Block, count(*) as n, {lit(R.BLOCK_OFF_MAP)} as Reason from all_by_id
        where Block not in (select NM_INDEX from blocks_flat) group by 1""",
)
def unmatched_blocks(spark, sf_dir):
    return spatial.unmatched_blocks(stage(spark, sf_dir, "all_by_id"), casting.blocks(spark, sf_dir), R.BLOCK_OFF_MAP)


# Locations


@probe("clean_locations", "select * from locations")
def clean_locations(spark, sf_dir):
    return location_stage(spark, sf_dir).kept


def _summary_sql(step: str, known: list[str]) -> str:
    values = ", ".join(f"({lit(r)})" for r in known)
    return (
        f'select r.Reason, count(t.Reason) as "Count" from (values {values}) r(Reason) '
        f"left join (select Reason from {step}) t on r.Reason = t.Reason group by 1"
    )


@probe("location_rejects", _summary_sql("location_reasons", R.LOCATION))
def location_rejects(spark, sf_dir):
    return location_stage(spark, sf_dir, stage_table).summary()


_LOCATION_ROW = ("id_loc", "year", "ID_CODE", "MODE_FX", "survey", "HGSIZE", "hgsize2", rejects.REASON)


@probe("location_reject_rows", f"select {', '.join(_LOCATION_ROW)} from location_reasons")
def location_reject_rows(spark, sf_dir):
    return location_stage(spark, sf_dir, stage_table).rejects.select(*_LOCATION_ROW)


_BEFORE_RANGES = (R.LOCATION_REPLACED, R.LOCATION_NO_YEAR, R.MISSING_ID, R.LOCATION_NOT_BOAT, R.LOCATION_EMPTY)


@probe(
    "range_sizes",
    f"""select HGSIZE, hgsize2, count(*) as n from i8_tagged
        where Reason is null or Reason not in ({', '.join(lit(r) for r in _BEFORE_RANGES)})
        group by 1, 2""",
)
def range_sizes(spark, sf_dir):
    coded = locations.location_codes(locations.stack_locations(*casting.location_files(spark, sf_dir)))
    tagged = locations.screen_locations(coded)
    return locations.range_sizes(tagged.kept.withColumn(rejects.REASON, F.lit(None).cast("string")).unionByName(tagged.rejects))


@probe(
    "location_screens",
    "select id_loc, year, MODE_FX, ddlat, ddlong, HGSIZE, hgsize2, Reason from i8_tagged where Reason is not null",
)
def location_screens(spark, sf_dir):
    stacked = locations.stack_locations(*casting.location_files(spark, sf_dir))
    screened = locations.screen_locations(locations.location_codes(stacked))
    return screened.rejects.select("id_loc", "year", "MODE_FX", "ddlat", "ddlong", "HGSIZE", "hgsize2", rejects.REASON)


# Effort and parties

_ROW = 'id, year, prim1, prim2, LEADER, PRT_CODE, FIRST, survey, CNTRBTRS, DAYSF, "primary"'


def _primary(spark, sf_dir):
    rows = effort.normalise_effort(effort.effort_rows(survey(spark, sf_dir, "i1")))
    return species.primary_target(rows, species_of(spark, sf_dir))


@probe("primary_target", f"select {_ROW} from effort_primary")
def primary_target(spark, sf_dir):
    return _primary(spark, sf_dir)


@probe("party_rollup", f"select {_ROW} from rolled")
def party_rollup(spark, sf_dir):
    return party.rollup_parties(_primary(spark, sf_dir)).kept


@probe(
    "party_rejects",
    f"""select id, LEADER, PRT_CODE, {lit(R.EFFORT_UNPLACED)} as Reason from roles where role = 'unplaced'
        union all select id, LEADER, PRT_CODE, {lit(R.EFFORT_FOLLOWER_ALONE)} from roles
                  where role = 'follower' and LEADER_ID not in (select id from roles where role = 'leader')""",
)
def party_rejects(spark, sf_dir):
    return party.rollup_parties(_primary(spark, sf_dir)).rejects.select("id", "LEADER", "PRT_CODE", rejects.REASON)


@probe("leader_map", "select * from leaders")
def leader_map(spark, sf_dir):
    return leaders_of(spark, sf_dir)


@probe(
    "leader_remap",
    """select coalesce(LEADER_ID || locn, id) as id, coalesce(LEADER_ID, r.ID_CODE) as ID_CODE, locn, SP_CODE
       from (select r.id, h.ID_CODE, r.locn, r.SP_CODE from observed_rows r join heads h on r.id = h.id_loc) r
       left join leaders d on r.ID_CODE = d.ID_CODE""",
)
def leader_remap(spark, sf_dir):
    heads = stage(spark, sf_dir, "locations").select("id_loc", "ID_CODE").distinct()
    rows = catch.observed_rows(survey(spark, sf_dir, "i3")).select("id", "locn", "SP_CODE")
    placed = joins.skew_join(rows, heads, [("id", "id_loc")])
    return party.remap_to_leader(placed, leaders_of(spark, sf_dir)).select("id", "ID_CODE", "locn", "SP_CODE")


@probe("effort_by_block", "select id, year, Block, CNTRBTRS, DAYSF, Common_Name, TripType_Description from effort_blocks")
def effort_by_block(spark, sf_dir):
    rolled = party.rollup_parties(_primary(spark, sf_dir)).kept
    named = joins.keyed_join(rolled, species.target_species(species_of(spark, sf_dir)), [("primary", "code_text")])
    rows = named.withColumn("id", X.prefixed("id"))
    placed = effort.effort_by_block(rows, stage(spark, sf_dir, "locations"))
    return placed.select("id", "year", "Block", "CNTRBTRS", "DAYSF", "Common_Name", "TripType_Description")


@probe(
    "aggregate_effort",
    """select id as id_noloc, year, Block, Common_Name, TripType_Description, sum(DAYSF) as Days, sum(CNTRBTRS) as Cntrbs,
              cast(count(*) as double) as Vessels, sum(DAYSF) * sum(CNTRBTRS) as AnglerDays
       from effort_blocks group by 1, 2, 3, 4, 5""",
)
def aggregate_effort(spark, sf_dir):
    rolled = party.rollup_parties(_primary(spark, sf_dir)).kept
    named = joins.keyed_join(rolled, species.target_species(species_of(spark, sf_dir)), [("primary", "code_text")])
    rows = named.withColumn("id", X.prefixed("id"))
    return effort.aggregate_effort(effort.effort_by_block(rows, stage(spark, sf_dir, "locations")))


@probe("effort", "select * from oe")
def effort_query(spark, sf_dir):
    return effort_stage(spark, sf_dir).kept


@probe("effort_rejects", _summary_sql("effort_reasons", R.EFFORT))
def effort_rejects(spark, sf_dir):
    return effort_stage(spark, sf_dir, stage_table).summary()


_EFFORT_ROW = ("id", "year", "prim1", "FIRST", "survey", "CNTRBTRS", "DAYSF", rejects.REASON)


@probe("effort_reject_rows", f"select {', '.join(_EFFORT_ROW)} from effort_reasons")
def effort_reject_rows(spark, sf_dir):
    return effort_stage(spark, sf_dir, stage_table).rejects.select(*_EFFORT_ROW)


@probe(
    "target_types",
    """select TripType_Description, count(*) as n from effort_named group by 1""",
)
def target_types(spark, sf_dir):
    rolled = party.rollup_parties(_primary(spark, sf_dir)).kept
    named = joins.keyed_join(rolled, species.target_species(species_of(spark, sf_dir)), [("primary", "code_text")])
    return dedupe.group_sizes(named, ["TripType_Description"]).orderBy(F.desc("n"))


# Catch


@probe("observed_catch", f"select * replace (round(Total_Obs_Fish_Caught, 6) as Total_Obs_Fish_Caught, round(Ob_AvKWgt, 6) as Ob_AvKWgt) from oc")
def observed_catch(spark, sf_dir):
    return rounded(observed_stage(spark, sf_dir).kept, "Total_Obs_Fish_Caught", "Ob_AvKWgt")


@probe("observed_rejects", _summary_sql("observed_reasons", R.OBSERVED))
def observed_rejects(spark, sf_dir):
    return observed_stage(spark, sf_dir, stage_table).summary()


_OBSERVED_ROW = ("id", "locn", "year", "SP_CODE", "fish", "weight", rejects.REASON)


@probe("observed_reject_rows", f"select {', '.join(_OBSERVED_ROW)} from observed_reasons where Reason is not null")
def observed_reject_rows(spark, sf_dir):
    return observed_stage(spark, sf_dir, stage_table).rejects.select(*_OBSERVED_ROW)


@probe(
    "unrepeat_weights",
    """select id, locn, year, SP_CODE, count(*) as rows, round(sum(fish / n), 6) as fish, sum(weight) as weight,
              count(weight) as weighed
       from (select *, count(*) over (partition by id, SP_CODE) as n from observed_rows where SP_CODE is not null) r
       group by 1, 2, 3, 4""",
)
def unrepeat_weights(spark, sf_dir):
    rows = catch.usable(catch.observed_rows(survey(spark, sf_dir, "i3")))
    return rounded(catch.unrepeat_weights(catch.collapse_weighed(rows)), "fish")


@probe(
    "spread_over_blocks",
    """select l_orderkey as trip, s_suppkey as Block, round(l_quantity / b, 6) as fish
       from lineitem join (select s_suppkey // 4 as place, s_suppkey, count(*) over (partition by s_suppkey // 4) as b from supplier) s
       on case when l_linenumber < 3 then 1 else l_suppkey // 4 end = place""",
)
def spread_over_blocks(spark, sf_dir):
    """Four blocks a place; one place holds the catch of two lines of every order."""
    caught = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as trip", "if(l_linenumber < 3, 1, l_suppkey div 4) as id", "l_quantity as fish"
    )
    blocks = load(spark, sf_dir, "supplier").selectExpr("s_suppkey div 4 as id_loc", "s_suppkey as Block")
    targets = blocks.join(dedupe.group_sizes(blocks, ["id_loc"], "total_blocks"), "id_loc")
    return rounded(catch.spread_over_blocks(caught, targets, ["fish"]).select("trip", "Block", "fish"), "fish")


@probe(
    "disposition",
    """select id, SP_CODE, DISPO, fish, case when DISPO in ('1', '2') then fish else 0.0 end as alive,
              case when DISPO = '6' then fish else 0.0 end as dead,
              case when DISPO in ('3', '4', '5', '7') then fish else 0.0 end as kept from reported_rows""",
)
def disposition(spark, sf_dir):
    rows = catch.reported_rows(survey(spark, sf_dir, "i2"))
    return catch.split_disposition(rows).select("id", "SP_CODE", "DISPO", "fish", "alive", "dead", "kept")


_RC = ("Rep_Released_Alive", "Rep_Released_Dead", "Rep_Kept", "Total_Rep_Fish_Caught", "Rep_Released")


@probe("reported_catch", f"select id, ID_CODE, year, Block, SP_CODE, Common_Name, TripType_Description, {r6(*_RC)} from rc")
def reported_catch(spark, sf_dir):
    return rounded(reported_stage(spark, sf_dir).kept, *_RC)


@probe("reported_rejects", _summary_sql("reported_reasons", R.REPORTED))
def reported_rejects(spark, sf_dir):
    return reported_stage(spark, sf_dir, stage_table).summary()


_REPORTED_ROW = ("id", "locn", "year", "SP_CODE", "DISPO", "fish", rejects.REASON)


@probe("reported_reject_rows", f"select {', '.join(_REPORTED_ROW)} from reported_reasons where Reason is not null")
def reported_reject_rows(spark, sf_dir):
    return reported_stage(spark, sf_dir, stage_table).rejects.select(*_REPORTED_ROW)


# The assembled table

_ALL_KEYS = ("id", "year", "Block", "SP_CODE", *asm.NAMES)
_ALL_SUMS = (*asm.MEASURES, "Total_Fish_Caught")


@probe("assemble", f"select {', '.join(_ALL_KEYS)}, {r6(*_ALL_SUMS)} from all_by_id")
def assemble(spark, sf_dir):
    return rounded(assemble_stage(spark, sf_dir).kept, *_ALL_SUMS)


@probe(
    "catch_without_effort",
    f"""select id, year, Block, SP_CODE, Common_Name_catch, {lit(R.CATCH_NO_EFFORT)} as Reason from assembled
        where Common_Name_catch is not null and Common_Name_effort is null""",
)
def catch_without_effort(spark, sf_dir):
    return assemble_stage(spark, sf_dir).rejects.select("id", "year", "Block", "SP_CODE", "Common_Name_catch", rejects.REASON)


@probe("combos", f"select {', '.join(asm.NAMES)}, count(*) as n from assembled group by 1, 2, 3, 4")
def combos(spark, sf_dir):
    both = asm.all_catch(stage(spark, sf_dir, "oc"), stage(spark, sf_dir, "rc"))
    return asm.combos(asm.with_effort(both, stage(spark, sf_dir, "oe")))


@probe(
    "effort_without_catch",
    """select id, year, Block, Common_Name_effort, TripType_Description_effort, AnglerDays from assembled
       where Common_Name_catch is null and Common_Name_effort is not null""",
)
def effort_without_catch(spark, sf_dir):
    both = asm.all_catch(stage(spark, sf_dir, "oc"), stage(spark, sf_dir, "rc"))
    return asm.effort_without_catch(asm.with_effort(both, stage(spark, sf_dir, "oe")))


@probe(
    "blocks_off_map_rows",
    f"""select id, year, Block, SP_CODE, round(Total_Fish_Caught, 6) as Total_Fish_Caught, {lit(R.BLOCK_OFF_MAP)} as Reason
        from all_by_id where Block is null or Block not in (select NM_INDEX from blocks_flat)""",
)
def blocks_off_map_rows(spark, sf_dir):
    listed = spatial.rows_off_map(stage(spark, sf_dir, "all_by_id"), casting.blocks(spark, sf_dir), R.BLOCK_OFF_MAP)
    return rounded(listed.select("id", "year", "Block", "SP_CODE", "Total_Fish_Caught", rejects.REASON), "Total_Fish_Caught")


@probe(
    "result_duplicates",
    """select id, Block, Common_Name_catch, TripType_Description_effort, count(*) as n from all_by_id
       group by 1, 2, 3, 4 having count(*) > 1""",
)
def result_duplicates(spark, sf_dir):
    keys = ["id", "Block", "Common_Name_catch", "TripType_Description_effort"]
    return dedupe.dup_audit(stage(spark, sf_dir, "all_by_id"), keys)


# Outliers


@probe(
    "zscore_outliers",
    """select k, g, x, round(z, 6) as z_score from (
         select k, g, x, (x - avg(x) over (partition by g)) / nullif(stddev_samp(x) over (partition by g), 0) as z
         from (select l_orderkey as k, nullif(l_suppkey % 10, 3) as g, nullif(l_quantity, 7.0) as x from lineitem) l) t
       where z > 1.5""",
)
def zscore_outliers(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k", "nullif(l_suppkey % 10, 3) as g", "nullif(l_quantity, 7.0D) as x"
    )
    return rounded(outliers.outliers(lines, "x", "g", 1.5), "z_score")


@probe(
    "weight_zscores",
    """select id, Block, SP_CODE, locn, year, Common_Name,
              round((Ob_AvKWgt - avg(Ob_AvKWgt) over (partition by Common_Name))
                    / nullif(stddev_samp(Ob_AvKWgt) over (partition by Common_Name), 0), 6) as z_score_weight from oc""",
)
def weight_zscores(spark, sf_dir):
    scored = outliers.with_zscore(stage(spark, sf_dir, "oc"), "Ob_AvKWgt", "Common_Name", "z_score_weight")
    return rounded(
        scored.select("id", "Block", "SP_CODE", "locn", "year", "Common_Name", "z_score_weight"), "z_score_weight"
    )


@probe(
    "weight_outliers",
    """select id, ID_CODE, locn, year, Block, SP_CODE, Common_Name, TripType_Description, Ob_Weighed_Fish,
              round(Total_Obs_Fish_Caught, 6) as Total_Obs_Fish_Caught, round(Ob_AvKWgt, 6) as Ob_AvKWgt,
              round(z, 6) as z_score_weight from (
         select *, (Ob_AvKWgt - avg(Ob_AvKWgt) over (partition by Common_Name))
                   / nullif(stddev_samp(Ob_AvKWgt) over (partition by Common_Name), 0) as z from oc) w where z > 1.5""",
)
def weight_outliers(spark, sf_dir):
    listed = outliers.weight_outliers(stage(spark, sf_dir, "oc"), 1.5)
    return rounded(listed, "Total_Obs_Fish_Caught", "Ob_AvKWgt", "z_score_weight")


_OUTLIER_SUMS = (*(m for m in asm.MEASURES if m != "Vessels"), "Total_Fish_Caught")


def _rate_outliers_sql(rate: str, name: str) -> str:
    sums = r6(*_OUTLIER_SUMS, "Total_CPUA", "Obs_CPUA", "Rep_CPUA")
    return f"""select id, year, Block, Common_Name_catch, TripType_Description_effort, {sums}, round(z, 6) as {name} from (
        select *, ({rate} - avg({rate}) over (partition by Common_Name_catch))
                  / nullif(stddev_samp({rate}) over (partition by Common_Name_catch), 0) as z
        from (select *, Total_Fish_Caught / nullif(AnglerDays, 0) as Total_CPUA,
                     Total_Obs_Fish_Caught / nullif(AnglerDays, 0) as Obs_CPUA,
                     Total_Rep_Fish_Caught / nullif(AnglerDays, 0) as Rep_CPUA from all_by_id) r) s where z > 10"""


def _listed(df: DataFrame) -> DataFrame:
    return rounded(df, *[c for c, kind in df.dtypes if kind == "double"])


@probe("observed_rate_outliers", _rate_outliers_sql("Obs_CPUA", "z_score_obs"))
def observed_rate_outliers(spark, sf_dir):
    return _listed(outliers.observed_rate_outliers(stage(spark, sf_dir, "all_by_id")))


@probe("reported_rate_outliers", _rate_outliers_sql("Rep_CPUA", "z_score_rep"))
def reported_rate_outliers(spark, sf_dir):
    return _listed(outliers.reported_rate_outliers(stage(spark, sf_dir, "all_by_id")))


# Map layers


def groups_of(spark, sf_dir):
    """The 0/1 matrix of species and groups."""
    name = F.col("Common_Name")
    return species_of(spark, sf_dir).select(
        name.alias("Common_Name_catch"),
        (name.startswith("red ") | name.startswith("blue ")).cast("int").alias("Rockfish"),
        name.endswith(" rod").cast("int").alias("Perch"),
    ).distinct()


def _rates(spark, sf_dir, name: str, trip: str, period: str = "year") -> DataFrame:
    table = layers.with_month(stage(spark, sf_dir, "all_by_id"))
    chosen = species.select_trip(species.select_species(table, name, groups_of(spark, sf_dir)), trip)
    return layers.cpua(chosen, species.select_trip(table, trip), name, period)


_CPUA = """Block, Trip as TripType_Description_effort, {p}, AnglerDays, n_samples_effort, Catch as Common_Name_catch,
           round(TotalCatch, 6) as TotalCatch, Kept, Released, CPUA_All, CPUA_Kept"""


@probe(
    "species_group",
    """select "group", count(*) as n, round(sum(Total_Fish_Caught), 6) as fish
       from all_by_id join (select Common_Name_catch, 'Rockfish' as "group" from species_groups where Rockfish = 1
                            union all select Common_Name_catch, 'Perch' from species_groups where Perch = 1) g
       using (Common_Name_catch) group by 1""",
)
def species_group(spark, sf_dir):
    table, groups = stage(spark, sf_dir, "all_by_id"), groups_of(spark, sf_dir)
    tagged = reshape.union_strict(*[species.select_species(table, g, groups) for g in species.group_names(groups)])
    sums = tagged.groupBy(F.col("Common_Name_catch").alias("group"))
    return rounded(sums.agg(F.count(F.lit(1)).alias("n"), F.sum("Total_Fish_Caught").alias("fish")), "fish")


@probe(
    "group_members",
    """select Common_Name_catch, 'Rockfish' as "group" from species_groups where Rockfish = 1
       union all select Common_Name_catch, 'Perch' from species_groups where Perch = 1""",
)
def group_members(spark, sf_dir):
    return species.group_members(groups_of(spark, sf_dir))


@probe("effort_grain", "select Block, Trip as TripType_Description_effort, year, AnglerDays, n_samples_effort from effort_one")
def effort_grain(spark, sf_dir):
    return layers.effort_grain(species.select_trip(stage(spark, sf_dir, "all_by_id"), "All"))


@probe("cpua_year", f"select {_CPUA.format(p='year')} from cpua_group")
def cpua_year(spark, sf_dir):
    return rounded(_rates(spark, sf_dir, "Rockfish", "Bottomfish"), "TotalCatch")


def _period_sql(period: str, rates: str, year: str, month: str) -> str:
    columns = _CPUA.format(p=f"{year} as year, {month} as month")
    return f"select '{period}' as period, {columns} from {rates}"


@probe(
    "cpua_periods",
    _period_sql("year", "cpua_group", "year", "cast(null as bigint)")
    + " union all " + _period_sql("month", "cpua_month", "cast(null as varchar)", "month"),
)
def cpua_periods(spark, sf_dir):
    """Year and month rates from one scan."""
    table = layers.with_month(stage(spark, sf_dir, "all_by_id"))
    flagged = species.select_trip(species.flag_species(table, "Rockfish", groups_of(spark, sf_dir)), "Bottomfish")
    return rounded(layers.cpua_periods(flagged, "Rockfish"), "TotalCatch")


@probe("cpua_all_trips", f"select {_CPUA.format(p='year')} from cpua_one")
def cpua_all_trips(spark, sf_dir):
    return rounded(_rates(spark, sf_dir, "red widget", "All"), "TotalCatch")


@probe(
    "layer_long",
    """select Block, Catch, Trip, n_samples_effort as Samples, year, AnglerDays, round(TotalCatch, 6) as TotalCatch, Kept,
              Released, CPUA_All, CPUA_Kept, x0 as corner
       from cpua_group join blocks_flat on Block = NM_INDEX where n_samples_effort >= 3""",
)
def layer_long(spark, sf_dir):
    long = layers.layer_long(_rates(spark, sf_dir, "Rockfish", "Bottomfish"))
    placed = layers.to_layer(long, casting.blocks(spark, sf_dir))
    return rounded(placed.withColumn("corner", F.expr("rings[0][0].x")).drop("rings"), "TotalCatch")


@probe(
    "layer_wide",
    "select w.Block, w.Catch, w.Trip, "
    + ", ".join(f"coalesce(w.Y{y}, -9999) as Y{y}" for y in layers.WIDE_YEARS)
    + ", t.CPUA_All, t.Samples from (select Block, Catch, Trip, "
    + ", ".join(f"max(case when year = '{y}' then CPUA_All end) as Y{y}" for y in layers.WIDE_YEARS)
    + " from cpua_group group by 1, 2, 3) w join years_total t on w.Block = t.Block and w.Catch = t.Catch"
    + " where t.Samples >= 3",
)
def layer_wide(spark, sf_dir):
    return layers.layer_wide(stage_table(_rates(spark, sf_dir, "Rockfish", "Bottomfish"), "cpua_year"), "CPUA_All")


def _wide_sql(years, metric: str, tail: str = "") -> str:
    columns = ", ".join(f"coalesce(w.Y{y}, -9999) as Y{y}" for y in years)
    values = ", ".join(f"max(case when year = '{y}' then {metric} end) as Y{y}" for y in years)
    return (
        f"select w.Block, w.Catch, w.Trip, {columns}, t.{metric}, t.Samples{', x0 as corner' if tail else ''}"
        f" from (select Block, Catch, Trip, {values} from cpua_group group by 1, 2, 3) w"
        f" join years_total t on w.Block = t.Block and w.Catch = t.Catch {tail} where t.Samples >= 3"
    )


_ON_MAP = "join blocks_flat on w.Block = NM_INDEX"
_ALL_YEARS = tuple(range(1992, 2030))


def _placed(result: DataFrame, spark, sf_dir) -> DataFrame:
    return layers.to_layer(result, casting.blocks(spark, sf_dir)).withColumn("corner", F.expr("rings[0][0].x")).drop("rings")


@probe("layer_wide_years", _wide_sql(_ALL_YEARS, "CPUA_All"))
def layer_wide_years(spark, sf_dir):
    """The wide layer for years that a run names, beyond the usual ones."""
    yearly = stage_table(_rates(spark, sf_dir, "Rockfish", "Bottomfish"), "cpua_year")
    return layers.layer_wide(yearly, "CPUA_All", years=_ALL_YEARS)


@probe("layer_wide_kept", _wide_sql(layers.WIDE_YEARS, "CPUA_Kept", _ON_MAP))
def layer_wide_kept(spark, sf_dir):
    yearly = stage_table(_rates(spark, sf_dir, "Rockfish", "Bottomfish"), "cpua_year")
    return _placed(layers.layer_wide(yearly, "CPUA_Kept"), spark, sf_dir)


@probe(
    "rate_audit",
    """select count(*) as rows, count(*) filter (where AnglerDays = 0) as zero_effort,
              count(*) filter (where cast(year as int) not between 2006 and 2010) as outside_years,
              count(*) filter (where cast(year as int) not between 2004 and 2020) as outside_ranges from cpua_group""",
)
def rate_audit(spark, sf_dir):
    joined = _rates(spark, sf_dir, "Rockfish", "Bottomfish")
    return layers.rate_audit(joined, range(2006, 2011), X.YEAR_RANGES[:3])


_RANGES = [label for label, _, _ in X.YEAR_RANGES]


@probe(
    "layer_grouped",
    "select w.*, t.CPUA_Kept, t.CPUA_All, t.Samples from (select Block, Catch, Trip, "
    + ", ".join(
        f"coalesce(max(case when year_group = '{r}' then CPUA_{m} end), -9999) as {m}_{r}" for m in ("All", "Kept") for r in _RANGES
    )
    + " from years_ranged group by 1, 2, 3) w join years_total t on w.Block = t.Block and w.Catch = t.Catch"
    + " where t.Samples >= 3",
)
def layer_grouped(spark, sf_dir):
    return layers.layer_grouped(stage_table(_rates(spark, sf_dir, "Rockfish", "Bottomfish"), "cpua_year"))


@probe(
    "layer_grouped_placed",
    "select w.*, t.CPUA_Kept, t.CPUA_All, t.Samples, x0 as corner from (select Block, Catch, Trip, "
    + ", ".join(
        f"coalesce(max(case when year_group = '{r}' then CPUA_{m} end), -9999) as {m}_{r}" for m in ("All", "Kept") for r in _RANGES
    )
    + f" from years_ranged group by 1, 2, 3) w join years_total t on w.Block = t.Block and w.Catch = t.Catch {_ON_MAP}"
    + " where t.Samples >= 3",
)
def layer_grouped_placed(spark, sf_dir):
    return _placed(layer_grouped(spark, sf_dir), spark, sf_dir)


@probe(
    "layer_monthly_placed",
    """select Block, Catch, Trip, n_samples_effort as Samples, '19' || lpad(cast(month as varchar), 2, '0') as time, month,
              AnglerDays, round(TotalCatch, 6) as TotalCatch, Kept, Released, CPUA_All, CPUA_Kept, x0 as corner
       from cpua_month join blocks_flat on Block = NM_INDEX where n_samples_effort >= 3""",
)
def layer_monthly_placed(spark, sf_dir):
    return _placed(layer_monthly(spark, sf_dir), spark, sf_dir)


@probe(
    "layer_monthly",
    """select Block, Catch, Trip, n_samples_effort as Samples, '19' || lpad(cast(month as varchar), 2, '0') as time, month,
              AnglerDays, round(TotalCatch, 6) as TotalCatch, Kept, Released, CPUA_All, CPUA_Kept
       from cpua_month where n_samples_effort >= 3""",
)
def layer_monthly(spark, sf_dir):
    return rounded(layers.layer_monthly(_rates(spark, sf_dir, "Rockfish", "Bottomfish", "month")), "TotalCatch")


@probe(
    "year_range",
    """select o_orderkey as k, case when y between 2004 and 2009 then '04_09' when y between 2010 and 2015 then '10_15'
              when y between 2016 and 2020 then '16_20' when y between 2021 and 2023 then '21_23' end as year_group
       from (select o_orderkey, year(o_orderdate) + 5 + o_custkey % 20 as y from orders) o""",
)
def year_range(spark, sf_dir):
    years = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", "cast(year(o_orderdate) + 5 + o_custkey % 20 as varchar(4)) as y"
    )
    return years.select("k", X.year_range("y").alias("year_group"))


# Sources and sinks, through the folder all executors share


@probe(
    "delimited_round_trip",
    f"""select cast(l_orderkey as varchar) as k, {blank('mixed')} as mixed, cast(nullif(l_suppkey, 7) as varchar) as s
        from (select l_orderkey, l_suppkey, {_MIXED} as mixed from lineitem) a""",
)
def delimited_round_trip(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as varchar(20)) as k", f"{_MIXED} as mixed", "cast(nullif(l_suppkey, 7) as varchar(20)) as s"
    )
    path = f"{shared_dir(spark)}/delimited-{uuid.uuid4().hex}"
    writers.write_table(lines, path, "csv")
    return readers.read_raw(spark, path, columns=lines.columns)


@probe(
    "quoted_round_trip",
    """select cast(l_orderkey as varchar) as k, 'a "' || l_linenumber || '", b' as quoted,
              case when l_suppkey % 3 = 0 then '"' end as mark from lineitem""",
)
def quoted_round_trip(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as varchar(20)) as k", """concat('a "', l_linenumber, '", b') as quoted""",
        """case when l_suppkey % 3 = 0 then '"' end as mark""",
    )
    path = f"{shared_dir(spark)}/quoted-{uuid.uuid4().hex}"
    writers.write_table(lines, path, "csv")
    return readers.read_raw(spark, path)


@probe(
    "yearly_files",
    "select cast(o_orderkey as varchar) as id_code, cast(year(o_orderdate) as varchar) as YEAR from orders",
)
def yearly_files(spark, sf_dir):
    """A file per parity of the year; their columns stand in different orders."""
    orders = load(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as varchar(20)) as id_code", "cast(year(o_orderdate) as varchar(4)) as YEAR"
    )
    path = f"{shared_dir(spark)}/yearly-{uuid.uuid4().hex}"
    writers.write_table(orders.filter("YEAR % 2 = 0"), f"{path}/even", "csv")
    writers.write_table(orders.filter("YEAR % 2 = 1").select("YEAR", "id_code"), f"{path}/odd", "csv")
    files = [f"{path}/even", f"{path}/odd"]
    return readers.read_yearly(spark, files, "part").select("id_code", "YEAR")


@probe("stage_round_trip", "select l_orderkey as k, nullif(l_quantity, 7.0) as q, nullif(l_suppkey, 3) as s from lineitem")
def stage_round_trip(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").selectExpr("l_orderkey as k", "nullif(l_quantity, 7.0D) as q", "nullif(l_suppkey, 3) as s")
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    writers.write_table(lines, path)
    return readers.read_stage(spark, path)


@probe(
    "layer_columns",
    "select Block, n from (select NM_INDEX as Block, count(*) as n from blocks_flat group by 1) b",
)
def layer_columns(spark, sf_dir):
    """Those of a list of columns that are there, in the list's order."""
    counts = casting.blocks(spark, sf_dir).groupBy(F.col("NM_INDEX").alias("Block")).agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("z"))
    return counts.select(*reshape.present_of(counts, ["Block", "missing", "n"]))


@probe(
    "point_in_mixed_polygons",
    """select k, NM_INDEX from
       (select c_custkey as k, -127 + c_custkey % 832 / 64.0 as lon, 32 + c_custkey % 704 / 64.0 as lat from customer) p left join (
         select * from blocks_flat union all select 'wide', -140.0, 20.0, false) b
         on lon >= x0 and lat >= y0
        and case when NM_INDEX = 'wide' then lon <= -121 and lat <= 40
                 when triangle then (lon - x0) + (lat - y0) <= 1.5
                 else lon <= x0 + 1.25 and lat <= y0 + 1.25 end""",
)
def point_in_mixed_polygons(spark, sf_dir):
    """Small blocks and one of many times their size: several grids."""
    ring = "array(named_struct('x', -140D, 'y', 20D), named_struct('x', -121D, 'y', 20D), named_struct('x', -121D, 'y', 40D), named_struct('x', -140D, 'y', 40D))"
    wide = spark.range(1).selectExpr("'wide' as NM_INDEX", f"array({ring}) as rings")
    layer = casting.blocks(spark, sf_dir).select("NM_INDEX", "rings").unionByName(wide)
    points = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey as k", "-127 + c_custkey % 832 / 64D as lon", "32 + c_custkey % 704 / 64D as lat"
    )
    return spatial.locate_points(points, layer).select("k", "NM_INDEX")


@probe(
    "layer_round_trip",
    "select NM_INDEX, x0, y0, cast(case when triangle then 3 else 4 end as int) as corners from blocks_flat",
)
def layer_round_trip(spark, sf_dir):
    layer = casting.blocks(spark, sf_dir).withColumn("total", F.lit(1))
    path = f"{shared_dir(spark)}/layer-{uuid.uuid4().hex}"
    writers.write_layer(layer, path)
    back = readers.read_polygons(spark, path)
    return back.selectExpr("NM_INDEX", "rings[0][0].x as x0", "rings[0][0].y as y0", "size(rings[0]) as corners")


@probe(
    "sorted_table",
    "select count(*) as rows, cast(sum(l_orderkey) as bigint) as keys, true as in_order from lineitem",
)
def sorted_table(spark, sf_dir):
    """A sorted write: the ranges of its files follow each other."""
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    path = f"{shared_dir(spark)}/sorted-{uuid.uuid4().hex}"
    back = writers.write_table(rows, path, sort_by=["l_orderkey", "l_linenumber"])
    files = back.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")
    )
    before = F.lag("high").over(Window.orderBy("file"))  # a row per file
    checked = files.withColumn("fine", F.coalesce(F.col("low") >= before, F.lit(True)))
    return checked.agg(F.sum("n").alias("rows"), F.sum("keys").alias("keys"), F.every("fine").alias("in_order"))


@probe(
    "schema_difference",
    """select 'orders' as side, column_name, (select count(*) from orders) as n
       from (describe select * from orders) where column_name <> 'o_custkey'
       union all select 'customer', column_name, (select count(*) from customer)
       from (describe select * from customer) where column_name <> 'c_custkey'""",
)
def schema_difference(spark, sf_dir):
    """Columns that one of two tables lacks, after both took part in a union by name."""
    orders = load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    customer = load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    left, right = reshape.schema_difference(orders, customer)
    stacked = reshape.union_by_name(orders, customer)
    counted = stacked.agg(*[F.count(c).alias(c) for c in [*left, *right]])
    names = counted.unpivot([], [*left, *right], "column_name", "n")
    return names.select(F.when(F.col("column_name").isin(left), "orders").otherwise("customer").alias("side"), "column_name", "n")


@probe(
    "layer_with_holes",
    """select nation, cast(2 as bigint) as parts, cast(3 as bigint) as part_rings, k, inside from (
         select n_nationkey as nation, c_custkey as k,
                (greatest(abs(x), abs(y)) <= 8 and greatest(abs(x), abs(y)) >= 4) or greatest(abs(x), abs(y)) <= 1 as inside
         from (select c_custkey, c_nationkey, c_custkey % 21 - 10 as x, c_custkey % 19 - 9 as y from customer) join nation on n_nationkey = c_nationkey)""",
)
def layer_with_holes(spark, sf_dir):
    """Squares with a hole and an island in it, written as features and read back: two parts, three rings."""
    ring = "array(named_struct('x', {0}-{1}D, 'y', -{1}D), named_struct('x', {0}+{1}D, 'y', -{1}D), named_struct('x', {0}+{1}D, 'y', {1}D), named_struct('x', {0}-{1}D, 'y', {1}D))"
    middle = "100D * n_nationkey "
    layer = load(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as string) as NM_INDEX", f"array({ring.format(middle, 1)}, {ring.format(middle, 8)}, {ring.format(middle, 4)}) as rings"
    )
    path = f"{shared_dir(spark)}/layer-{uuid.uuid4().hex}"
    written = writers.write_layer(layer, path)
    shape = written.selectExpr(
        "get_json_object(value, '$.properties.NM_INDEX') as nation_text",
        "size(from_json(get_json_object(value, '$.geometry.coordinates'), 'array<array<array<array<double>>>>')) as parts",
    )
    back = readers.read_polygons(spark, path)
    points = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey as k", "c_nationkey", "100D * c_nationkey + (c_custkey % 21 - 10) as lon", "cast(c_custkey % 19 - 9 as double) as lat"
    )
    located = spatial.locate_points(points, back.select("NM_INDEX", "rings"))
    rings = back.selectExpr("NM_INDEX as nation_text", "size(rings) as part_rings")
    return (
        located.withColumn("nation_text", F.col("c_nationkey").cast("string")).join(shape, "nation_text").join(rings, "nation_text")
        .selectExpr("c_nationkey as nation", "cast(parts as bigint) as parts", "cast(part_rings as bigint) as part_rings", "k", "NM_INDEX is not null as inside")
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey tables to the long map layer."""
    return layer_long(configure(spark), sf_dir)
