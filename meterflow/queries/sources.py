"""Queries S1-S18."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from meterflow.plans.stage import new_path
from meterflow.queries.registry import Registry
from meterflow.schemas import DEFAULTS, TABLES
from meterflow.sources import reports, tables

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


WORD = "case cast(substr(meter_id, 2) as int) % 6 when 0 then 'TRUE' when 1 then '' when 2 then 'No' when 3 then ' yes ' when 4 then '0' else 'odd' end"


@R.query("""select meter_id, name, building_id, media_type_id, case cast(substr(meter_id, 2) as int) % 6 when 0 then true when 3 then true when 5 then null else false end as is_virtual_meter,
    cast(null as varchar) as identifier, valid_from, cast(null as date) as valid_to from meters""")
def s1_scan_table(s):
    """A CSV file with Boolean words, empty cells and missing columns, read as the table of meters."""
    path = new_path(s.spark, "meters.csv")
    s.meters.select("meter_id", "name", "building_id", "media_type_id", F.expr(WORD).alias("is_virtual_meter"), F.col("valid_from").cast("string").alias("valid_from")).write.option("header", True).csv(path)
    return tables.scan_table(s.spark, path, tables.schema_of("meters"), DEFAULTS["meters"])


@R.query("select sources, timeseries_id, cast(valid_from as varchar) as valid_from, aggregation from derived_refs")
def s2_write_table(s):
    """What is written, as text cell by cell: lists joined by pipes, nulls empty, columns in the order asked for."""
    path = new_path(s.spark, "refs.csv")
    tables.write_table(s.derived_refs.withColumn("sources", tables.split_list(F.col("sources"))), path, ["sources", "timeseries_id", "valid_from", "aggregation"])
    return s.spark.read.option("header", True).csv(path)


STORED = {"campuses": "campuses", "buildings": "buildings", "zones": "zones", "meters": "meters", "meter_relations": "relations", "sensors": "sensors", "readings": "readings"}


COLUMNS = {n: ",".join(c.split()[0] for c in ddl.split(", ")) for n, ddl in TABLES.items()}


@R.query(" union all ".join(
    f"select '{n}' as name, '{c}' as columns, " + (f"(select count(*) from {STORED[n]}) as n" if n in STORED else "cast(0 as bigint) as n") for n, c in COLUMNS.items()
))
def s3_load_dataset(s):
    """Rows and columns of the 13 tables of a folder that lacks some of the files."""
    folder = new_path(s.spark, "dataset")
    for name, fixture in STORED.items():
        tables.write_table(getattr(s, fixture), f"{folder}/{name}.csv")
    loaded = tables.load_dataset(s.spark, folder)
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit(",".join(df.columns)).alias("columns"), "n") for name, df in loaded.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


@R.query("""select parent_meter_id, child_meter_id, relation_type, flow_coefficient, valid_from, cast(null as date) as valid_to, derived_from from relations""")
def s4_typed_dates(s):
    text = s.relations.select(*(F.col(c).cast("string").alias(c) for c in s.relations.columns)).withColumn("valid_to", F.lit(""))
    return tables.typed(text, tables.schema_of("meter_relations"))


# the export: unreadable numbers on some days
EXPORT = """export as (
    select meter_id, quantity, cast(day as varchar(10)) as day, case when day(day) = 7 then 'n/a' else cast(cast(v_first as bigint) as varchar(20)) end as v_first,
           cast(cast(v_last as bigint) as varchar(20)) as v_last, case when day(day) % 5 = 0 then '' else cast(n_readings as varchar(9)) end as n from register)"""


def export_of(s):
    d = F.dayofmonth("day")
    return s.register.select(
        F.col("meter_id").alias("METER_ID"), F.col("quantity").alias("QUANTITY"), F.col("day").cast("string").alias("DAY"),
        F.when(d == 7, "n/a").otherwise(F.col("v_first").cast("long").cast("string")).alias("V_FIRST"), F.col("v_last").cast("long").cast("string").alias("V_LAST"),
        F.when(d % 5 == 0, "").otherwise(F.col("n_readings").cast("string")).alias("N_READINGS"),
    )


@R.query(f"""with {EXPORT} select meter_id, cast(day as date) as day, try_cast(v_first as double) as v_first, try_cast(v_last as double) as v_last,
    coalesce(try_cast(n as bigint), 0) as n_readings from export
    where quantity = 'energy' and meter_id in (select meter_id from listed) and try_cast(v_first as double) is not null and try_cast(v_last as double) is not null""")
def s5_scan_register(s):
    return tables.scan_register(export_of(s), s.listed, "energy")


@R.query("""with a as (select * from meters where media_type_id = 'el'), b as (select * from meters where media_type_id = 'heat')
    select 'buildings' as name, building_id as id, name as label, cast(null as varchar) as media from (
        select *, row_number() over (partition by building_id order by src desc) as rn from (
            select building_id, name, 0 as src from buildings union all select building_id, concat(name, ' new'), 1 from buildings where campus_id = 'C1') x) y where rn = 1
    union all select 'reported', building_id, month, 'el' from reported
    union all select 'reported', building_id, month, 'heat' from reported where month = '2024-01'""")
def s6_assemble_site(s):
    one = {"buildings": s.buildings.select("building_id", "name", "campus_id"), "reported": s.reported}
    two = {"buildings": s.buildings.where("campus_id = 'C1'").select("building_id", F.concat("name", F.lit(" new")).alias("name")), "reported": s.reported.where("month = '2024-01'")}
    site = tables.assemble_site({"el": one, "heat": two})
    none = F.lit(None).cast("string").alias("media")
    return (
        site["buildings"].select(F.lit("buildings").alias("name"), F.col("building_id").alias("id"), F.col("name").alias("label"), none)
        .unionByName(site["reported"].select(F.lit("reported").alias("name"), F.col("building_id").alias("id"), F.col("month").alias("label"), "media"))
    )


WINDOWED = """windowed as (
    select concat(timeseries_id, '.A') as timeseries_id, external_id, cast(null as date) as valid_from, date '2024-01-12' as valid_to from refs
    union all select concat(timeseries_id, '.B'), external_id, date '2024-01-14', cast(null as date) from refs)"""


def windowed_of(s):
    day = lambda d: F.lit(d).cast("date")
    a = s.refs.select(F.concat("timeseries_id", F.lit(".A")).alias("timeseries_id"), "external_id", day(None).alias("valid_from"), day("2024-01-12").alias("valid_to"))
    return a.unionByName(s.refs.select(F.concat("timeseries_id", F.lit(".B")).alias("timeseries_id"), "external_id", day("2024-01-14").alias("valid_from"), day(None).alias("valid_to")))


@R.query(f"""with {WINDOWED} select w.timeseries_id, cast(r.day as timestamp) as timestamp, r.v_last as value from register r join windowed w on w.external_id = r.meter_id
    where r.quantity = 'energy' and (w.valid_from is null or w.valid_from <= r.day) and (w.valid_to is null or w.valid_to > r.day)""")
def s7_extract_readings(s):
    return tables.extract_readings(s.register.where("quantity = 'energy'"), windowed_of(s))


@R.query("""select meter_id, case when building_id is not null then 'building' else 'campus' end as target_kind, coalesce(building_id, 'C0') as target_id,
    cast(null as date) as valid_from, cast(null as date) as valid_to from meters""")
def s8_default_measures(s):
    return tables.default_measures(s.meters, "C0")


MANUAL = "manual as (select concat('X', substr(meter_id, 2)) as external_id, month, delta as value from meter_monthly)"


@R.query(f"""with {MANUAL}, o as (
        select t.timeseries_id, m.month, m.value from refs t join manual m on m.external_id = t.external_id
        where t.timeseries_id not in (select concat('T', u) from users where u % 3 <> 0))
    select timeseries_id, cast(last_day(cast(concat(month, '-01') as date)) as timestamp) as timestamp, sum(value) over (partition by timeseries_id order by month) as value from o
    union all select distinct timeseries_id, timestamp '2023-12-31 00:00:00', 0.0 from o""")
def s9_inject_manual(s):
    have = s.users.where("u % 3 <> 0").select(F.concat(F.lit("T"), "u").alias("timeseries_id"))
    manual = s.meter_monthly.select(F.concat(F.lit("X"), F.expr("substr(meter_id, 2)")).alias("external_id"), "month", F.col("delta").alias("value"))
    return reports.inject_manual(s.refs, have, manual)


@R.query("""select meter_id, month, delta as value from meter_monthly where not (month <> '2024-01' and delta % 2 = 0)""")
def s10_unpivot_months(s):
    """All months as columns of text, with a dash for some values."""
    months = [f"2024-0{k}" for k in range(1, 8)]
    wide = s.meter_monthly.groupBy("meter_id").pivot("month", months).agg(F.sum("delta"))
    cell = lambda m: F.when((F.col(f"`{m}`") % 2 == 0) & F.lit(m != months[0]), "-").otherwise(F.col(f"`{m}`").cast("string"))
    return reports.unpivot_months(wide.select("meter_id", *(cell(m).alias(f"m{k}") for k, m in enumerate(months))), "meter_id", {f"m{k}": m for k, m in enumerate(months)})


# labels of every kind: what they are made of, and the id they stand for
LABELS = [
    ("concat(' ', u % 90, ' ')", "concat('B', u % 90)"), ("concat('B', u % 90, 'A (T)')", "concat('B', u % 90, 'A')"), ("concat(u % 90, ' (T)')", "concat('B', u % 90)"),
    ("concat('Summa ', u)", "null"), ("concat('B', u % 90, '.VP1_VMM61')", "null"), ("concat(u, '-A')", "concat('B', u, '-A')"), ("concat('Intagsmätare ånga B', u % 7, ' ny')", "concat('B', u % 7)"),
    ("'INTAGSMÄTARE'", "'BINTAGSMÄTARE'"), ("'parkering'", "'BPARKING'"), ("concat('B', u, ' Norra')", "concat('B', u, ' Norra')"), ("concat(u, ' (I&L)')", "null"), ("'Trädgård'", "null"), ("concat(u, 'c')", "concat('B', u, 'c')"),
]
LABEL, LABEL_ID = ("case u % 13 " + " ".join(f"when {i} then {x[k]}" for i, x in enumerate(LABELS)) + " end" for k in (0, 1))


@R.query(f"select {LABEL} as label, {LABEL_ID} as building_id from users")
def s11_building_id(s):
    return s.users.select(F.expr(LABEL).alias("label")).withColumn("building_id", reports.building_id_of(F.col("label")))


TOTALS = "totals as (select building_id, month, value, 1 as position from reported union all select building_id, month, case when month = '2024-02' then -value else value - 1 end, 2 from reported)"


@R.query(f"""with {TOTALS} select building_id, month, value from (
    select *, row_number() over (partition by building_id, month order by abs(value) desc, position) as rn from totals) x where rn = 1""")
def s12_dedupe_totals(s):
    a = s.reported.withColumn("position", F.lit(1))
    b = s.reported.withColumn("value", F.when(F.col("month") == "2024-02", -F.col("value")).otherwise(F.col("value") - 1)).withColumn("position", F.lit(2))
    return reports.dedupe_totals(a.unionByName(b))


TERMS = """sheet_terms as (select concat('sheet', u % 12) as sheet, case when u % 12 = 3 and u % 5 = 0 then 0.25e0 end as scalar,
    case when u % 12 = 4 then 0.5e0 when u % 12 = 5 and u % 7 = 0 then cast(null as double) when u % 12 = 6 then 1.0e0 + u % 2 else 0.5e0 end as faktor from users)"""


@R.query(f"""with {TERMS} select sheet, coalesce(max(case when scalar > 0 and scalar < 1 then scalar end),
    case when count(distinct faktor) = 1 and count(faktor) = count(*) then min(faktor) end, 1.0) as factor from sheet_terms group by 1""")
def s13_sheet_factor(s):
    u = F.col("u")
    faktor = F.when(u % 12 == 4, 0.5).when((u % 12 == 5) & (u % 7 == 0), None).when(u % 12 == 6, 1.0 + u % 2).otherwise(0.5)
    rows = s.users.select(F.concat(F.lit("sheet"), u % 12).alias("sheet"), F.when((u % 12 == 3) & (u % 5 == 0), 0.25).alias("scalar"), faktor.alias("faktor"))
    return reports.sheet_factor(rows)


@R.query("""with t as (select child_meter_id as meter_id, case when relation_type = 'feeds' then 'add' else 'sub' end as role, parent_meter_id as building from relations)
    select meter_id, string_agg(distinct role, '|' order by role) as roles, string_agg(distinct building, '|' order by building) as buildings from t group by 1""")
def s14_meters_used(s):
    role = F.when(F.col("relation_type") == "feeds", "add").otherwise("sub")
    return reports.meters_used(s.relations.select(F.col("child_meter_id").alias("meter_id"), role.alias("role"), F.col("parent_meter_id").alias("building")))


@R.query("""select meter_id, coalesce(building_id, '') as building_id, case when media_type_id = 'el' then ' El' else 'heat' end as media from meters where media_type_id = 'el'""")
def s15_intake_catalog(s):
    rows = s.meters.select("meter_id", "building_id", F.when(F.col("media_type_id") == "el", " El").otherwise("heat").alias("media"))
    return reports.intake_catalog(rows, "EL")


@R.query("""select concat('M', u) as key, case when u % 4 = 0 then concat('M', u) else concat('X', u) end as id from users
    union all select concat('label ', u % 30), arg_max(concat('X', u), u) from users where u % 4 <> 0 group by u % 30""")
def s16_crosswalk(s):
    rows = s.users.select(F.concat(F.lit("M"), "u").alias("facit"), F.when(F.col("u") % 4 == 0, " ").otherwise(F.concat(F.lit("X"), "u")).alias("register"), F.concat(F.lit("label "), F.col("u") % 30).alias("label"), "u")
    return reports.crosswalk(rows, "facit", "register", own=True).unionByName(reports.crosswalk_by_labels(rows, "register", [F.col("label"), F.lit("")], "u"))


@R.query("select distinct meter_id from (select meter_id from meters union all select child_meter_id from relations union all select meter_id from listed) x")
def s17_draft_crosswalk(s):
    return reports.draft_crosswalk([s.meters, s.relations.select(F.col("child_meter_id").alias("meter_id")), s.listed], "meter_id")


@R.query("""select building_id, name, campus_id from buildings where campus_id not in ('C1', 'C2')
    union all select building_id, concat('new ', name), cast(null as varchar) from buildings where campus_id = 'C1'
    union all select 'B999', 'added', cast(null as varchar)""")
def s18_keyed_overlay(s):
    base = s.buildings.select("building_id", "name", "campus_id")
    patch = base.where("campus_id = 'C1'").select("building_id", F.concat(F.lit("new "), "name").alias("name"))
    patch = patch.unionByName(s.spark.sql("select 'B999' as building_id, 'added' as name"))
    return tables.keyed_overlay(base, patch, base.where("campus_id = 'C2'"), ["building_id"])
