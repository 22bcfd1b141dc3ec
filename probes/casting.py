"""The driver's tables cast as survey tables.

Line items play the location, reported and observed rows, orders the effort rows,
parts the species and suppliers the map blocks. Everything is whole-table column
arithmetic, so the survey tables grow with the driver's. The same SELECT serves
both engines; only the functions whose names differ are filled in per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creelgrid.operators.reshape import blanks_to_null
from creelgrid.operators.species import clean_species
from creelgrid.plans.rebuild import Survey
from creelgrid.session import stage_table

SOURCES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(k: str, dialect: str) -> str:
    days = f"cast({k} % 6900 as int)"
    if dialect == "spark":
        return f"date_add(date '2004-01-01', {days})"
    return f"(date '2004-01-01' + {days})"


def id_code(k: str, dialect: str) -> str:
    """A trip id: five digits, the day, and a number that keeps ids apart."""
    day = _day(k, dialect)
    text = f"date_format({day}, 'yyyyMMdd')" if dialect == "spark" else f"strftime({day}, '%Y%m%d')"
    number = f"cast(cast(floor({k} / 90000) as bigint) as varchar(20))"
    return f"concat(cast(10000 + {k} % 90000 as varchar(20)), {text}, {number})"


def year_of(k: str, dialect: str) -> str:
    return f"cast(year({_day(k, dialect)}) as varchar(4))"


def _text(expression: str) -> str:
    return f"cast({expression} as varchar(20))"


def _survey(k: str, dialect: str) -> str:
    return (
        f"case when {k} % 4 = 0 and year({_day(k, dialect)}) <= 2013 then null "
        f"when {k} % 2 = 0 then 'PR1' else 'PR2' end"
    )


def selects(dialect: str) -> dict[str, str]:
    """SELECT text of every survey table over the driver's tables."""
    k = "l_orderkey"
    o = "o_orderkey"
    own, year, survey = id_code(k, dialect), year_of(k, dialect), _survey(k, dialect)
    locn = "case l_linenumber % 4 when 0 then '0' when 1 then '' when 2 then '1' else '2' end"
    whole = "cast(cast(l_quantity as int) as varchar(20))"
    lead = f"({o} - {o} % 20)"
    copies = {
        "spark": "explode(sequence(0, cast(l_linenumber % 3 as int)))", "duckdb": "unnest(range(0, l_linenumber % 3 + 1))",
    }[dialect]
    odd_year = f"case when {k} % 97 = 3 then null when {k} % 97 = 5 then '20I2' else {year} end"
    effort = f"""
        select {id_code(o, dialect)} as ID_CODE,
               {year_of(o, dialect)} as YEAR,
               case when o_custkey % 40 = 0 then 'NFOTH' when o_custkey % 41 = 0 then null
                    else {_text('o_custkey')} end as prim1,
               case when {o} % 3 = 0 then {_text('o_custkey + 1')} when {o} % 3 = 1 then '' end as prim2,
               case when {o} % 50 = 1 then null when {o} % 50 = 2 then 'x' else {_text(f'{o} % 6')} end as CNTRBTRS,
               case when {o} % 45 = 0 then null else {_text(f'{o} % 4')} end as DAYSF,
               case when {o} % 20 in (4, 12) then {id_code(lead, dialect)} end as LEADER,
               case when {o} % 20 in (8, 16) then {id_code(lead, dialect)} end as PRT_CODE,
               case when {o} % 140 = 0 then null else '1' end as FIRST,
               {_survey(o, dialect)} as survey
        from orders"""
    reported = f"""
        select {own} as ID_CODE, {locn} as locn, {year} as YEAR,
               case when l_partkey % 50 = 7 then 'LNGCD' when l_partkey % 53 = 0 then null
                    when l_partkey % 59 = 0 then {_text('l_partkey + 1000000000')}
                    else {_text('l_partkey')} end as SP_CODE,
               case when l_suppkey % 50 = 9 then '9' else {_text('l_linenumber')} end as DISPO,
               case when l_suppkey % 33 = 0 then null else {whole} end as NUM_FISH
        from lineitem"""
    observed = f"""
        select {own} as ID_CODE, {locn} as locn, {year} as YEAR,
               case when l_partkey % 50 = 7 then 'LNGCD' when l_partkey % 53 = 0 then null
                    when l_partkey % 59 = 0 then {_text('l_partkey + 1000000000')}
                    else {_text('l_partkey')} end as SP_CODE,
               '7' as MODE_F, '1' as DISP3,
               case when l_suppkey % 15 = 0 then 'WGT'
                    when (l_suppkey + fish) % 4 = 0 then null
                    else concat({_text('1 + (l_suppkey + fish) % 9')}, '.5') end as WGT,
               case when l_suppkey % 44 = 0 then null else {whole} end as FSHINSP
        from (select *, {copies} as fish from lineitem) lines"""
    return {
        "i8": f"""
        select {own} as ID_CODE, {locn} as locn, {odd_year} as YEAR,
               case when l_suppkey % 20 = 3 then '6' when l_partkey % 50 = 0 then null else '7' end as MODE_FX,
               case when l_linenumber = 7 and l_suppkey % 5 = 0 then 'PR3' else {survey} end as survey,
               case when {k} % 3 <> 0 then '' when {k} % 60 = 0 then '51.5' when {k} % 60 = 3 then '50'
                    when {k} % 60 = 12 then 'bad'
                    else concat({_text(f'32 + {k} % 17')}, '.', {_text(f'10 + 15 * ({k} % 5)')}) end as ddlat,
               case when {k} % 3 <> 0 then null when {k} % 60 = 6 then '151.5' when {k} % 60 = 9 then null
                    else concat({_text(f'116 + {k} % 11')}, '.', {_text(f'10 + 15 * ({k} % 4)')}) end as ddlong,
               case when l_partkey % 7 = 0 then '9999999' when l_partkey % 7 = 1 then null
                    else {_text('100 + l_suppkey % 100')} end as block1,
               case when l_partkey % 13 = 0 then null else concat('00', {_text('l_partkey % 3')}) end as box1a,
               case when l_partkey % 5 = 0 then {_text('l_partkey % 4')} end as box1b,
               case when l_partkey % 10 = 0 then '.' end as box1c,
               case when l_suppkey % 9 = 0 then {_text('1000 + l_suppkey % 50')} end as block2,
               case when l_suppkey % 18 = 0 then '012' end as box2a,
               cast(null as varchar(20)) as box2b,
               cast(null as varchar(20)) as box2c,
               case {k} % 25 when 0 then '3' when 1 then '1' when 2 then '0' end as HGSIZE,
               case when {k} % 28 = 5 then '2' when {k} % 7 = 0 then '1' end as hgsize2
        from lineitem""",
        "i1_once": effort,
        "i1": f"""
        select * from i1_once
        union all
        select ID_CODE, YEAR, prim1, prim2, '2' as CNTRBTRS, DAYSF, LEADER, PRT_CODE, FIRST, survey
        from ({effort} where {o} % 37 = 0) again""",
        "i2": f"""
        {reported}
        union all
        select ID_CODE, locn, YEAR, SP_CODE, DISPO,
               case when cast(NUM_FISH as int) % 2 = 0 then '77' else NUM_FISH end as NUM_FISH
        from ({reported} where l_suppkey % 31 = 1) again""",
        "i3": observed,
        "species_raw": """
        select cast(p_partkey as varchar(20)) as PSMFC_Code,
               concat('A', cast(p_partkey as varchar(20))) as ALPHA5,
               case when p_partkey % 90 = 4 then 'bivalve class   ' else concat(p_name, '     ') end as Common_Name,
               case when p_partkey % 30 = 0 then null else
                    case p_type when 'ECONOMY' then 'Invertebrates' when 'LARGE' then 'Bottomfish'
                                when 'MEDIUM' then 'Inshore' when 'PROMO' then 'Salmon'
                                when 'SMALL' then 'Highly migratory' else 'Bottomfish' end
               end as TripType_Description
        from part""",
        "blocks_flat": """
        select concat(cast(100 + s_suppkey % 100 as varchar(20)), '-',
                      cast(cast(floor(s_suppkey / 100) as bigint) as varchar(20))) as NM_INDEX,
               cast(-127 + s_suppkey % 10 as double) as x0,
               cast(32 + floor(s_suppkey / 10) as double) as y0,
               s_suppkey % 4 = 3 as triangle
        from supplier""",
    }


# Which survey tables a survey table reads.
NEEDS = {"i1": ("i1_once",)}


# Tables that stand for raw files: read, blanks made NULL. Those that a step reads several times are
# written once per session, the catch, which a step reads once, is not.
RAW = ("i8", "i1", "i2", "i3")
WRITTEN = ("i8", "i1")
_written: dict[tuple[str, str, str], DataFrame] = {}


def survey(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One survey table as a DataFrame over the driver's whole tables."""
    texts = selects("spark")
    text = texts[name]
    for helper in NEEDS.get(name, ()):
        text = f"with {helper} as ({texts[helper]}) {text}"
    for source in ("lineitem", "orders", "part", "supplier"):
        text = text.replace(f"from {source}", f"from parquet.`{sf_dir}/{source}.parquet`")
    if name not in RAW:
        return spark.sql(text)
    if name not in WRITTEN:
        return blanks_to_null(spark.sql(text))
    key = (spark.sparkContext.applicationId, str(sf_dir), name)
    if key not in _written:
        _written[key] = stage_table(blanks_to_null(spark.sql(text)), name)
    return _written[key]


def location_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Old rows of the north and the south, and the rows of the newer file, which also are among the old."""
    i8 = survey(spark, sf_dir, "i8")
    new = i8.filter("YEAR = '2016' and survey = 'PR1'").withColumnRenamed("ID_CODE", "id_code")
    return i8.filter("block1 < '150'"), i8.filter("not coalesce(block1 < '150', false)"), new


def raw_survey(spark: SparkSession, sf_dir: str) -> Survey:
    """All raw tables of a rebuild, split into old and newer files at 2016."""
    old, new = "try_cast(YEAR as int) < 2016 or try_cast(YEAR as int) is null", "try_cast(YEAR as int) >= 2016"
    i1, i2, i3 = (survey(spark, sf_dir, name) for name in ("i1", "i2", "i3"))
    north, south, newer = location_files(spark, sf_dir)
    return Survey(
        i1_old=i1.filter(old), i1_new=i1.filter(new), i2_old=i2.filter(old), i2_new=i2.filter(new),
        i3_old=i3.filter(old), i3_new=i3.filter(new), i8_old_north=north, i8_old_south=south, i8_new=newer,
        species=clean_species(survey(spark, sf_dir, "species_raw")), polygons=blocks(spark, sf_dir),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map blocks with rings: squares that overlap their neighbours, and triangles."""
    flat = survey(spark, sf_dir, "blocks_flat")
    point = "named_struct('x', cast({} as double), 'y', cast({} as double))"
    square = [("x0", "y0"), ("x0 + 1.25", "y0"), ("x0 + 1.25", "y0 + 1.25"), ("x0", "y0 + 1.25")]
    triangle = [("x0", "y0"), ("x0 + 1.5", "y0"), ("x0", "y0 + 1.5")]
    ring = "array({})"
    return flat.selectExpr(
        "NM_INDEX",
        "if(triangle, array({}), array({})) as rings".format(
            ring.format(", ".join(point.format(*p) for p in triangle)),
            ring.format(", ".join(point.format(*p) for p in square)),
        ),
    )
