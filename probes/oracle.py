"""The questions in SQL, written row by row as the results are defined.

Each entry of ``CTES`` is one named step; ``sql(name)`` puts the steps a query
needs in front of its SELECT. The steps join and count raw rows, unlike the Spark
side, which collapses groups first, so equal results check that rewriting.
"""

from __future__ import annotations

import re

from creelgrid import reasons as R

from .casting import selects


def blank(x: str, tokens: str = "'', '.', 'NA'") -> str:
    return f"(case when trim({x}) not in ({tokens}) then trim({x}) end)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^0+([0-9])', '\\1')"


def num(x: str) -> str:
    text = f"trim({x})"
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"(case when regexp_full_match({text}, '{pattern}') then cast({text} as double) end)"


def rnd(x: str, digits: int) -> str:
    """Half-even rounding of the decimal digits a double prints."""
    scaled = f"(cast(cast({x} as varchar) as decimal(34, 20)) * cast({10**digits} as decimal(4, 0)))"
    up = f"({scaled} - floor({scaled}) > 0.5 or ({scaled} - floor({scaled}) = 0.5 and cast(floor({scaled}) as bigint) % 2 = 1))"
    return f"(cast(floor({scaled}) + case when {up} then 1 else 0 end as double) / {10**digits}.0)"


def code(block: str, box: str) -> str:
    text = f"(coalesce({block}, '') || '-' || coalesce({box}, ''))"
    return f"case when length({text}) >= 5 then {text} end"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ATTRS = "year, ID_CODE, MODE_FX, survey, ddlat, ddlong, HGSIZE, hgsize2"
SIX = ("c1", "c2", "c3", "c4", "c5", "c6")
_num_range = lambda c: f"({c} is not null and coalesce({num(c)} > 1, true))"
_locn = f"case when {blank('locn')} is null or {strip(blank('locn'))} = '0' then '1' else {strip(blank('locn'))} end"

CTES: dict[str, str] = {name: text for name, text in selects("duckdb").items()}
CTES |= {
    "species": f"""
        select {num('PSMFC_Code')} as SP_CODE, {blank('PSMFC_Code', "''")} as code_text,
               {blank('ALPHA5', "''")} as Alpha, {blank('Common_Name', "''")} as Common_Name,
               {blank('TripType_Description', "''")} as TripType_Description
        from species_raw where trim(Common_Name) <> 'bivalve class'""",
    "species_groups": """
        select distinct trim(Common_Name) as Common_Name_catch,
               case when trim(Common_Name) like 'red %' or trim(Common_Name) like 'blue %' then 1 else 0 end as Rockfish,
               case when trim(Common_Name) like '% rod' then 1 else 0 end as Perch
        from species_raw where trim(Common_Name) <> 'bivalve class'""",
    "i8_stacked": f"""
        select *, case when {blank('YEAR')} is null then {lit(R.LOCATION_NO_YEAR)}
                       when {blank('YEAR')} = '2016' then {lit(R.LOCATION_REPLACED)} end as stack_reason from i8
        union all select *, null from i8 where YEAR = '2016' and survey = 'PR1'""",
    "i8_text": f"""
        select {blank('ID_CODE')} as ID_CODE, {_locn} as locn, {blank('YEAR')} as year,
               {blank('MODE_FX')} as MODE_FX, {blank('survey')} as survey, {blank('ddlat')} as lat_text,
               {num(blank('ddlat'))} as ddlat, {num(blank('ddlong'))} as ddlong,
               {blank('HGSIZE')} as HGSIZE, {blank('hgsize2')} as hgsize2,
               nullif({strip(blank('block1'))}, '9999999') as block1, {strip(blank('block2'))} as block2,
               {strip(blank('box1a'))} as box1a, {strip(blank('box1b'))} as box1b, {strip(blank('box1c'))} as box1c,
               {strip(blank('box2a'))} as box2a, {strip(blank('box2b'))} as box2b, {strip(blank('box2c'))} as box2c
               , stack_reason from i8_stacked""",
    "i8_coded": f"""
        select *, ID_CODE || locn as id_loc,
               {code('block1', 'box1a')} as c1, {code('block1', 'box1b')} as c2, {code('block1', 'box1c')} as c3,
               {code('block2', 'box2a')} as c4, {code('block2', 'box2b')} as c5, {code('block2', 'box2c')} as c6
        from i8_text""",
    "i8_tagged": f"""
        select *, {' and '.join(f'{c} is null' for c in SIX)} as blockless,
               case when stack_reason is not null then stack_reason
                    when id_loc is null then {lit(R.MISSING_ID)}
                    when coalesce({num('MODE_FX')} <> 7, true) then {lit(R.LOCATION_NOT_BOAT)}
                    when {' and '.join(f'{c} is null' for c in SIX)} and lat_text is null then {lit(R.LOCATION_EMPTY)}
                    when {_num_range('HGSIZE')} or {_num_range('hgsize2')} then {lit(R.LOCATION_RANGE)}
                    when {' and '.join(f'{c} is null' for c in SIX)}
                         and (ddlat > 50 or -ddlong < -150 or ddlong is null) then {lit(R.LOCATION_BAD_COORDS)}
                    when {' and '.join(f'{c} is null' for c in SIX)}
                         and not coalesce(ddlat < 50 and -ddlong > -150, false) then {lit(R.LOCATION_UNUSABLE_COORDS)}
               end as Reason
        from i8_coded""",
    "on_points": f"""
        select id_loc, year, ID_CODE, MODE_FX, survey, ddlat, -ddlong as ddlong, HGSIZE, hgsize2, NM_INDEX as Block
        from i8_tagged left join blocks_flat
             on -ddlong >= x0 and ddlat >= y0
            and case when triangle then (-ddlong - x0) + (ddlat - y0) <= 1.5
                     else -ddlong <= x0 + 1.25 and ddlat <= y0 + 1.25 end
        where Reason is null and blockless""",
    "located": "select id_loc, " + ATTRS + ", Block from on_points where Block is not null union all "
    + " union all ".join(
        f"select id_loc, {ATTRS}, {c} as Block from i8_tagged where Reason is null and {c} is not null" for c in SIX
    ),
    "merged": f"select id_loc, {ATTRS} from located group by all",
    "in_conflict": "select id_loc from merged group by id_loc having count(*) > 1",
    "locations": """
        select 'ID' || id_loc as id_loc, year, 'ID' || ID_CODE as ID_CODE, MODE_FX, survey, Block,
               cast(count(*) over (partition by id_loc) as int) as total_blocks
        from (select distinct id_loc, year, ID_CODE, MODE_FX, survey, Block from located
              where id_loc not in (select id_loc from in_conflict)) d""",
    "location_reasons": f"""
        select id_loc, year, ID_CODE, MODE_FX, survey, HGSIZE, hgsize2, Reason from i8_tagged where Reason is not null
        union all select id_loc, year, ID_CODE, MODE_FX, survey, HGSIZE, hgsize2, {lit(R.LOCATION_OFF_MAP)}
                  from on_points where Block is null
        union all select id_loc, year, ID_CODE, MODE_FX, survey, HGSIZE, hgsize2, {lit(R.LOCATION_CONFLICT)} from merged
                  where id_loc in (select id_loc from in_conflict)""",
    "heads": "select distinct id_loc, ID_CODE, total_blocks from locations",
    "effort_rows": f"""
        select {blank('ID_CODE')} as id, {blank('YEAR')} as year,
               {', '.join(f"{blank(c)} as {c}" for c in ('prim1', 'prim2', 'LEADER', 'PRT_CODE', 'FIRST', 'survey'))},
               case when {blank('CNTRBTRS')} is null then 0.0 else {num(blank('CNTRBTRS'))} end as CNTRBTRS,
               case when {blank('DAYSF')} is null then 0.0 else {num(blank('DAYSF'))} end as days0
        from i1""",
    "effort_primary": """
        select r.* exclude (days0), case when days0 = 0 and CNTRBTRS > 0 then 1.0 else days0 end as DAYSF,
               case when TripType_Description = 'Invertebrates' and prim2 is not null then prim2 else prim1 end as "primary"
        from effort_rows r left join species on prim1 = code_text""",
    "roles": f"""
        select *, case when not coalesce({num('year')} <= 2013 and survey is null, false) then 'other'
                       when LEADER is not null or PRT_CODE is not null then 'follower'
                       when {num('FIRST')} = 1 then 'leader' else 'unplaced' end as role,
               coalesce(LEADER, PRT_CODE) as LEADER_ID
        from effort_primary""",
    "rolled": """
        select id, year, prim1, prim2, LEADER, PRT_CODE, FIRST, survey,
               case when role = 'leader' then coalesce(CNTRBTRS, 0.0) + coalesce(led, 0.0) else CNTRBTRS end as CNTRBTRS,
               DAYSF, "primary"
        from roles left join (select LEADER_ID as lid, sum(CNTRBTRS) as led from roles
                              where role = 'follower' group by 1) f on role = 'leader' and id = lid
        where role in ('other', 'leader')""",
    "effort_named": """
        select 'ID' || id as id, year, prim1, prim2, LEADER, PRT_CODE, FIRST, survey, CNTRBTRS, DAYSF, "primary",
               Common_Name, TripType_Description
        from rolled join species on "primary" = code_text""",
    "effort_blocks": """
        select distinct n.*, Block from effort_named n join locations l on n.id = l.ID_CODE where CNTRBTRS > 0""",
    "effort_once": """
        select * from (select *, count(*) over (partition by id, Block, TripType_Description, year) as copies
                       from effort_blocks) c where copies = 1""",
    "oe": """
        select id as id_noloc, year, Block, Common_Name, TripType_Description,
               coalesce(sum(DAYSF), 0.0) as Days, coalesce(sum(CNTRBTRS), 0.0) as Cntrbs, sum(1.0)::double as Vessels,
               coalesce(sum(CNTRBTRS), 0.0) * coalesce(sum(DAYSF), 0.0) as AnglerDays
        from effort_once group by 1, 2, 3, 4, 5""",
    "trip_sets": """
        select distinct ID_CODE, blocks
        from (select id_loc, ID_CODE, list_sort(list(Block)) as blocks from locations group by 1, 2) s""",
    "effort_reasons": f"""
        select id, year, prim1, FIRST, survey, CNTRBTRS, DAYSF, {lit(R.EFFORT_UNPLACED)} as Reason
        from roles where role = 'unplaced'
        union all select id, year, prim1, FIRST, survey, CNTRBTRS, DAYSF, {lit(R.EFFORT_FOLLOWER_ALONE)} from roles
                  where role = 'follower' and LEADER_ID not in (select id from roles where role = 'leader')
        union all select 'ID' || id, year, prim1, FIRST, survey, CNTRBTRS, DAYSF, {lit(R.EFFORT_NO_SPECIES)} from rolled
                  where "primary" is null or "primary" not in (select code_text from species where code_text is not null)
        union all select id, year, prim1, FIRST, survey, CNTRBTRS, DAYSF, {lit(R.NO_LOCATION)} from effort_named
                  where id not in (select ID_CODE from locations)
        union all select id, year, prim1, FIRST, survey, CNTRBTRS, DAYSF, case when CNTRBTRS = 0 then {lit(R.EFFORT_NO_CONTRIBUTORS)}
                              else {lit(R.EFFORT_BAD_CONTRIBUTORS)} end
                  from effort_named n join trip_sets t on n.id = t.ID_CODE where not coalesce(CNTRBTRS > 0, false)
        union all select id, year, prim1, FIRST, survey, CNTRBTRS, DAYSF, {lit(R.EFFORT_AMBIGUOUS)}
                  from (select distinct * exclude (Block, copies)
                        from (select *, count(*) over (partition by id, Block, TripType_Description, year) as copies
                              from effort_blocks) c where copies > 1) a""",
    "leaders": f"""
        select 'ID' || id as ID_CODE, 'ID' || coalesce(LEADER, PRT_CODE, id) as LEADER_ID
        from effort_rows where {num('year')} <= 2013 and survey is null""",
    "observed_rows": f"""
        select 'ID' || {blank('ID_CODE')} || {_locn} as id, {_locn} as locn, {blank('YEAR')} as year,
               {num(blank('SP_CODE'))} as SP_CODE, coalesce({num(blank('FSHINSP'))}, 0.0) as fish,
               {num(blank('WGT'))} as weight
        from i3""",
    "observed_named": """
        select r.*, Common_Name, TripType_Description from observed_rows r join species using (SP_CODE) where id is not null""",
    "observed_placed": """
        select r.*, h.ID_CODE, total_blocks, fish / total_blocks / count(*) over (partition by id, SP_CODE) as per_block
        from observed_named r join heads h on r.id = h.id_loc""",
    "oc": """
        select coalesce(LEADER_ID || locn, p.id) as id, coalesce(LEADER_ID, p.ID_CODE) as ID_CODE, locn, p.year,
               Block, SP_CODE, Common_Name, TripType_Description, coalesce(sum(per_block), 0.0) as Total_Obs_Fish_Caught,
               avg(weight) as Ob_AvKWgt, count(weight) as Ob_Weighed_Fish
        from observed_placed p left join leaders d on p.ID_CODE = d.ID_CODE
             join locations l on l.id_loc = p.id
        group by 1, 2, 3, 4, 5, 6, 7, 8""",
    "observed_reasons": f"""
        select case when SP_CODE is null then {lit(R.CATCH_BAD_CODE)} when id is null then {lit(R.MISSING_ID)}
                    when SP_CODE not in (select SP_CODE from species where SP_CODE is not null) then {lit(R.CATCH_NO_SPECIES)}
                    when id not in (select id_loc from locations) then {lit(R.NO_LOCATION)} end as Reason,
               id, locn, year, SP_CODE, fish, weight
        from observed_rows""",
    "reported_rows": f"""
        select 'ID' || {blank('ID_CODE')} || {_locn} as id, {_locn} as locn, {blank('YEAR')} as year,
               {num(blank('SP_CODE'))} as SP_CODE, {blank('DISPO')} as DISPO,
               coalesce({num(blank('NUM_FISH'))}, 0.0) as fish
        from (select distinct * from i2) d""",
    "reported_placed": """
        select r.*, Common_Name, TripType_Description, ID_CODE, total_blocks, fish / total_blocks as per_block,
               count(*) over (partition by id, SP_CODE, DISPO) as copies
        from reported_rows r join species using (SP_CODE) join heads h on r.id = h.id_loc""",
    "rc_sums": """
        select coalesce(LEADER_ID || locn, p.id) as id, coalesce(LEADER_ID, p.ID_CODE) as ID_CODE, p.year, Block,
               SP_CODE, Common_Name, TripType_Description,
               sum(case when DISPO in ('1', '2') then per_block else 0.0 end) as Rep_Released_Alive,
               sum(case when DISPO in ('6') then per_block else 0.0 end) as Rep_Released_Dead,
               sum(case when DISPO in ('3', '4', '5', '7') then per_block else 0.0 end) as Rep_Kept
        from reported_placed p left join leaders d on p.ID_CODE = d.ID_CODE
             join locations l on l.id_loc = p.id
        where copies = 1 group by 1, 2, 3, 4, 5, 6, 7""",
    "rc": """
        select *, Rep_Released_Alive + Rep_Kept + Rep_Released_Dead as Total_Rep_Fish_Caught,
               Rep_Released_Alive + Rep_Released_Dead as Rep_Released
        from rc_sums""",
    "reported_reasons": f"""
        select case when SP_CODE is null then {lit(R.CATCH_BAD_CODE)} when id is null then {lit(R.MISSING_ID)}
                    when SP_CODE not in (select SP_CODE from species where SP_CODE is not null) then {lit(R.CATCH_NO_SPECIES)}
                    when id not in (select id_loc from locations) then {lit(R.NO_LOCATION)} end as Reason,
               id, locn, year, SP_CODE, DISPO, fish
        from reported_rows
        union all select {lit(R.CATCH_AMBIGUOUS)}, id, locn, year, SP_CODE, DISPO, fish
                  from reported_placed where copies > 1""",
    "catch_both": """
        select coalesce(o.id, r.id) as id, coalesce(o.ID_CODE, r.ID_CODE) as ID_CODE,
               coalesce(o.SP_CODE, r.SP_CODE) as SP_CODE, coalesce(o.Block, r.Block) as Block,
               coalesce(o.Common_Name, r.Common_Name) as Common_Name, coalesce(o.year, r.year) as year,
               o.* exclude (id, ID_CODE, SP_CODE, Block, Common_Name, TripType_Description, year, locn),
               r.* exclude (id, ID_CODE, SP_CODE, Block, Common_Name, TripType_Description, year)
        from oc o full join rc r on o.id is not distinct from r.id and o.ID_CODE is not distinct from r.ID_CODE
             and o.SP_CODE is not distinct from r.SP_CODE and o.Block is not distinct from r.Block
             and o.Common_Name is not distinct from r.Common_Name and o.year is not distinct from r.year""",
    "assembled": """
        select coalesce(c.id, c.ID_CODE, e.id_noloc) as id, coalesce(c.ID_CODE, e.id_noloc) as ID_CODE,
               coalesce(c.year, e.year) as year, coalesce(c.Block, e.Block) as Block, c.SP_CODE,
               c.Common_Name as Common_Name_catch, e.Common_Name as Common_Name_effort,
               s.TripType_Description as TripType_Description_catch,
               e.TripType_Description as TripType_Description_effort,
               Ob_Weighed_Fish, Ob_AvKWgt, Total_Obs_Fish_Caught, Rep_Released_Dead, Rep_Kept, Rep_Released_Alive,
               Total_Rep_Fish_Caught, Days, Cntrbs, Vessels, AnglerDays
        from (catch_both c left join species s on c.Common_Name = s.Common_Name and c.SP_CODE = s.SP_CODE)
             full join oe e on c.ID_CODE is not distinct from e.id_noloc and c.Block is not distinct from e.Block
             and c.year is not distinct from e.year""",
    "all_by_id": """
        select *, Total_Obs_Fish_Caught + Total_Rep_Fish_Caught as Total_Fish_Caught
        from (select id, year, Block, SP_CODE, Common_Name_catch, Common_Name_effort, TripType_Description_catch,
                     TripType_Description_effort, cast(coalesce(Ob_Weighed_Fish, 0) as double) as Ob_Weighed_Fish, """
    + ", ".join(
        f"coalesce({c}, 0.0) as {c}"
        for c in (
            "Ob_AvKWgt", "Total_Obs_Fish_Caught", "Rep_Released_Dead", "Rep_Kept", "Rep_Released_Alive",
            "Total_Rep_Fish_Caught", "Days", "Cntrbs", "Vessels", "AnglerDays",
        )
    )
    + """
              from assembled where Common_Name_catch is null or Common_Name_effort is not null) f""",
}


def _cpua_steps(tag: str, catch: str, effort: str, species: str, period: str) -> dict[str, str]:
    """Steps of one map table: effort grain, catch grain and their rates."""
    return {
        f"effort_{tag}": f"""
            select Block, Trip, {period}, sum(AnglerDays) as AnglerDays, count(distinct id) as n_samples_effort
            from (select distinct id, {period}, Block, Vessels, AnglerDays, Trip from {effort}) t group by 1, 2, 3""",
        f"catch_{tag}": f"""
            select Block, Catch, Trip, {period}, round(sum(Total_Fish_Caught), 9) as TotalCatch,
                   {rnd('round(sum(Total_Obs_Fish_Caught), 9)', 2)} as Kept, {rnd('round(sum(Total_Rep_Fish_Caught), 9)', 2)} as Released
            from {catch} group by 1, 2, 3, 4""",
        f"cpua_{tag}": f"""
            select e.*, coalesce(nullif(Catch, ''), {lit(species)}) as Catch, TotalCatch, Kept, Released,
                   coalesce({rnd('TotalCatch / nullif(AnglerDays, 0)', 3)}, 0.0) as CPUA_All,
                   coalesce({rnd('Kept / nullif(AnglerDays, 0)', 3)}, 0.0) as CPUA_Kept
            from effort_{tag} e left join catch_{tag} c on e.Block = c.Block and e.Trip = c.Trip
                 and e.{period} is not distinct from c.{period}""",
    }


_month = "cast(month(try_strptime(substr(id, 8, 8), '%Y%m%d')) as int)"
# the newer table alone, without the rows of earlier years
CTES["i8_plain_text"] = CTES["i8_text"].replace(", stack_reason from i8_stacked", "from i8")
CTES["i8_plain"] = CTES["i8_coded"].replace("i8_text", "i8_plain_text")
CTES |= {
    "group_trip": f"""
        select *, {_month} as month, 'Rockfish' as Catch, TripType_Description_effort as Trip from all_by_id
        where Common_Name_catch in (select Common_Name_catch from species_groups where Rockfish = 1)
          and TripType_Description_effort = 'Bottomfish'""",
    "any_trip": f"""
        select *, {_month} as month, TripType_Description_effort as Trip from all_by_id
        where TripType_Description_effort = 'Bottomfish'""",
    "one_all": """
        select *, Common_Name_catch as Catch, 'All' as Trip from all_by_id where Common_Name_catch = 'red widget'""",
    "any_all": "select *, 'All' as Trip from all_by_id",
}
CTES |= _cpua_steps("group", "group_trip", "any_trip", "Rockfish", "year")
CTES |= _cpua_steps("month", "group_trip", "any_trip", "Rockfish", "month")
CTES |= _cpua_steps("one", "one_all", "any_all", "red widget", "year")


def over_years(extra: str = "") -> str:
    more = f", {extra}" if extra else ""
    inner = f"""
        select Block, Catch, Trip{more}, sum(AnglerDays) as AnglerDays, round(coalesce(sum(TotalCatch), 0.0), 9) as TotalCatch,
               {rnd('round(coalesce(sum(Kept), 0.0), 9)', 2)} as Kept, {rnd('round(coalesce(sum(Released), 0.0), 9)', 2)} as Released,
               cast(sum(n_samples_effort) as bigint) as Samples
        from ranged group by Block, Catch, Trip{more}"""
    return f"""
        select *, coalesce({rnd('TotalCatch / nullif(AnglerDays, 0)', 3)}, 0.0) as CPUA_All,
               coalesce({rnd('Kept / nullif(AnglerDays, 0)', 3)}, 0.0) as CPUA_Kept
        from ({inner}) s"""


CTES |= {
    "ranged": """
        select *, case when cast(year as int) between 2004 and 2009 then '04_09'
                       when cast(year as int) between 2010 and 2015 then '10_15'
                       when cast(year as int) between 2016 and 2020 then '16_20'
                       when cast(year as int) between 2021 and 2023 then '21_23' end as year_group
        from cpua_group""",
    "years_total": over_years(),
    "years_ranged": over_years("year_group"),
}


def sql(select: str) -> str:
    """``select`` with the steps it needs, in order of need."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z][a-z0-9_]*\b", re.sub(r"'[^']*'", "", text))):
            if word in CTES and word not in order and re.search(rf"\b(from|join)\s+\(*{word}\b", text):
                visit(CTES[word])
                if word not in order:
                    order.append(word)

    visit(select)
    if not order:
        return select
    steps = ",\n".join(f"{name} as materialized ({CTES[name]})" for name in order)
    return f"with {steps}\n{select}"


def albers_sql(x: str, y: str) -> tuple[str, str]:
    """Longitude and latitude of a projected point, from the projection's published parameters alone:
    Albers on GRS80, parallels 34 and 40.5, meridian -120, false northing -4000000."""
    f = "(1.0 / 298.257222101)"
    e2 = f"({f} * (2 - {f}))"

    def m2(degrees: float) -> str:
        return f"(pow(cos(radians({degrees})), 2) / (1 - {e2} * pow(sin(radians({degrees})), 2)))"

    def q(degrees: float) -> str:
        s = f"sin(radians({degrees}))"
        return f"((1 - {e2}) * ({s} / (1 - {e2} * {s} * {s}) - ln((1 - sqrt({e2}) * {s}) / (1 + sqrt({e2}) * {s})) / (2 * sqrt({e2}))))"

    n = f"(({m2(34.0)} - {m2(40.5)}) / ({q(40.5)} - {q(34.0)}))"
    c = f"({m2(34.0)} + {n} * {q(34.0)})"
    dy = f"(6378137.0 * sqrt({c}) / {n} - ({y} + 4000000.0))"
    rho2 = f"({x} * {x} + {dy} * {dy})"
    beta = f"asin((({c} - {rho2} * pow({n} / 6378137.0, 2)) / {n}) / {q(90.0)})"
    lat = (
        f"degrees({beta} + ({e2} / 3 + 31 * pow({e2}, 2) / 180 + 517 * pow({e2}, 3) / 5040) * sin(2 * {beta})"
        f" + (23 * pow({e2}, 2) / 360 + 251 * pow({e2}, 3) / 3780) * sin(4 * {beta})"
        f" + (761 * pow({e2}, 3) / 45360) * sin(6 * {beta}))"
    )
    return f"(-120.0 + degrees(atan2({x}, {dy}) / {n}))", lat
